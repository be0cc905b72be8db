"""Independent SQL (DuckDB dialect) for every registered query: the same adapters and
model semantics written as plain SQL over the driver tables. Used as the correctness
oracle; never executed by the Spark code paths.

Each building block is a named CTE; ``sql(final, *ctes)`` assembles the WITH clause
(dependencies listed explicitly per block).
"""
from __future__ import annotations

AS_OF_ORDERS = "DATE '2001-06-01'"
AS_OF_EVENTS = "DATE '2024-01-31'"

_COMMA = "replace(cast(cast({x} as decimal(12,2)) as varchar), '.', ',')"


def comma(x: str) -> str:
    return _COMMA.format(x=x)


def clean(x: str) -> str:
    return f"cast(replace(nullif({x}, ''), ',', '.') as double)"


def hhmm_hours(x: str) -> str:
    return (f"case when length({x}) = 5 then cast(cast(cast(substr({x}, 1, 2) as integer) as decimal(5,2)) "
            f"+ cast(cast(substr({x}, 4, 2) as integer) / 60.0 as decimal(5,2)) as decimal(6,2)) end")


# (sql, deps)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


# ---------------------------------------------------------------- adapters
cte("src_employees", """
select c_custkey as id, 'Vorname' || cast(c_custkey as varchar) as first_name,
       'Nachname' || cast(c_custkey as varchar) as last_name, c_name as full_name,
       'c' || cast(c_custkey as varchar) || '@corp.test' as email,
       DATE '1960-01-01' + cast((c_custkey * 37) % 14000 as integer) as birthday_on,
       case when c_custkey % 10 = 0 then DATE '1998-01-01' + cast(c_custkey % 1000 as integer) end as terminated_on,
       case when c_custkey % 10 = 0 then c_mktsegment end as termination_reason,
       cast(null as varchar) as termination_reason_type, cast(null as varchar) as termination_observations,
       case when c_nationkey % 2 = 0 then 'female' else 'male' end as gender,
       'E' || cast(c_custkey as varchar) as company_identifier
from customer""")

cte("active", "select * from src_employees where terminated_on is null", "src_employees")
cte("terminated", """select id, terminated_on, termination_reason, termination_reason_type, termination_observations
from src_employees where terminated_on is not null""", "src_employees")

cte("contracts_base", """
select o_orderkey as id, o_custkey as employee_id, o_orderpriority as job_title,
       cast(o_orderdate as date) as effective_on, cast(o_orderdate as date) as starts_on,
       case when o_orderkey % 11 = 0 then cast(o_orderdate as date) + 180 end as ends_on,
       case when o_orderkey % 2 = 0 then 'monthly' else 'hourly' end as salary_frequency,
       'weekly' as working_hours_frequency,
       case when o_orderkey % 9 <> 0 then cast(floor(o_totalprice) as bigint) // 100 end as salary_amount,
       cast(case when o_orderkey % 3 = 0 then 4000 when o_orderkey % 3 = 1 then 3200 end as bigint) // 100
           as working_hours
from orders""")



def _nulls(kind: str, names: str) -> str:
    return "".join(f", null::{kind} as {n}" for n in names.split())


cte("contracts_full", f"""
select b.*, case when id % 4 = 0 then 'de' else 'es' end as country, id % 5 = 0 as es_has_teleworking_contract,
       case when id % 4 = 0 then id % 7 end as de_contract_type_id
       {_nulls("varchar", "role level working_week_days es_contract_observations es_job_description fr_employee_type compensation_ids")}
       {_nulls("boolean", "has_payroll fr_forfait_jours")}{_nulls("date", "trial_period_ends_on")}{_nulls("timestamp", "created_at updated_at")}
       {_nulls("bigint", "es_cotization_group es_contract_type_id es_working_day_type_id es_education_level_id es_professional_category_id "
               "fr_jours_par_an fr_coefficient fr_contract_type_id fr_level_id fr_step_id fr_mutual_id fr_professional_category_id "
               "fr_work_type_id pt_contract_type_id")}
from contracts_base b""", "contracts_base")

cte("active_full", f"""
select a.*{_nulls("varchar", "termination_type_description identifier identifier_type nationality bank_number swift_bic "
                  "bank_number_format country city state postal_code address_line_1 address_line_2 social_security_number tax_id "
                  "team_ids phone_number contact_name contact_number")}
       {_nulls("bigint", "company_id legal_entity_id manager_id location_id timeoff_manager_id timeoff_policy_id")}
       {_nulls("timestamp", "created_at updated_at")}
from active a""", "active")

cte("dim_employees", """
select u.id as factorial_id, u.company_identifier as employee_id, u.email, u.first_name, u.last_name, u.full_name,
       u.birthday_on as birthdate, u.gender, u.terminated_on as termination_date, s.start_date
from (select id, terminated_on, null::varchar as company_identifier, null::varchar as email,
             null::varchar as first_name, null::varchar as last_name, null::varchar as full_name,
             null::date as birthday_on, null::varchar as gender from terminated
      union all
      select id, terminated_on, company_identifier, email, first_name, last_name, full_name, birthday_on, gender
      from active) u
join (select employee_id, min(starts_on) as start_date from contracts_base group by employee_id) s
  on u.id = s.employee_id""", "terminated", "active", "contracts_base")

cte("filled", f"""
select id as contract_id, employee_id, job_title, effective_on as date, salary_amount, salary_frequency,
       working_hours, working_hours_frequency,
       case when ends_on is not null then ends_on
            when nxt is not null then cast(nxt - 1 as date)
            when termination_date is not null then termination_date
            when effective_on > {AS_OF_ORDERS} then cast(effective_on + interval 1 year as date)
            else cast({AS_OF_ORDERS} + interval 1 year as date) end as end_date
from (select c.*, e.termination_date,
             lead(c.effective_on) over (partition by c.employee_id order by c.effective_on, c.id) as nxt
      from contracts_base c left join dim_employees e on c.employee_id = e.factorial_id) x
where salary_amount is not null""", "contracts_base", "dim_employees")

cte("salary", """
select employee_id as factorial_id, contract_id, salary_amount as amount, cast(d as date) as date,
       'Salary' as type, 'Salary' as name
from (select *, unnest(generate_series(cast(date as timestamp), cast(end_date as timestamp), interval 1 month)) as d
      from filled) x""", "filled")

cte("comp_base", """
select l_orderkey * 8 + l_linenumber as id, l_orderkey as contract_version_id,
       'Zulage ' || l_returnflag || l_linestatus as description,
       case when l_linenumber <> 7 then cast(floor(l_quantity * 50) as bigint) // 100 end as amount,
       cast(l_suppkey % 5 as bigint) as contracts_taxonomy_id,
       case when l_linenumber % 2 = 0 then cast(l_shipdate as date) end as starts_on,
       null::date as first_payment_on
from lineitem""")

cte("benefit", """
select factorial_id, amount, date, end_date, type, name, contract_version_id, contracts_taxonomy_id, compensation_id
from (select *, row_number() over (partition by date, contracts_taxonomy_id, factorial_id, amount
                                   order by compensation_id, end_date, type, name, contract_version_id) as rn
      from (select factorial_id, amount, cast(d as date) as date, end_date, type, name, contract_version_id,
                   contracts_taxonomy_id, compensation_id
            from (select f.employee_id as factorial_id, c.amount, f.end_date, 'Benefit' as type,
                         c.description as name, c.contract_version_id, c.contracts_taxonomy_id,
                         c.id as compensation_id,
                         unnest(generate_series(cast(coalesce(c.starts_on, f.date) as timestamp),
                                                cast(f.end_date as timestamp), interval 1 month)) as d
                  from comp_base c join filled f on c.contract_version_id = f.contract_id
                  where c.amount is not null and c.amount <> 0) a) b) z
where rn = 1""", "comp_base", "filled")

cte("mapping", """
select cast(id as integer) as id, email, troi_name, cast(jahr as date) as jahr, name, urlaubsanspruch_pt,
       resturlaub_vorjahr
from (select cast(c_custkey as varchar) as id, null::varchar as jahr, null::varchar as name,
             'c' || cast(c_custkey as varchar) || '@corp.test' as email, c_name as troi_name,
             null::double as urlaubsanspruch_pt, null::double as resturlaub_vorjahr from customer
      union all
      select cast(c_custkey as varchar), null, null, 'alt' || cast(c_custkey as varchar) || '@corp.test', c_name,
             null, null from customer where c_custkey % 50 = 0
      union all
      select cast(c_custkey as varchar), cast(2020 + c_custkey % 5 as varchar) || '-01-01', c_name, null, null,
             cast(20 + c_custkey % 11 as double), cast(c_custkey % 5 as double) from customer) s""")

cte("lunchit_src", f"""
select strftime(l_shipdate, '%d.%m.%Y') as Abrechnungsmonat, strftime(l_shipdate, '%d.%m.%Y') as Datum,
       {comma('l_extendedprice')} as Eingereichter_Betrag, {comma('l_quantity')} as Erstattungsbetrag,
       case when l_linenumber = 3 then '' else {comma('l_quantity')} end as Zuzahlung,
       {comma('l_tax * 100')} as Lunchit_1_2, {comma('l_discount * 100')} as Lunchit_2_2,
       case when l_linenumber = 5 then '' else cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) end
           as Lunchit_Beleg_ID,
       case when l_linenumber = 6 then '' else cast(l_partkey as varchar) || ',0' end as id
from lineitem""")

cte("lunchit", f"""
select Lunchit_Beleg_ID as lunchit_beleg_id, {clean('Lunchit_1_2')} as lunchit_1_2,
       {clean('Lunchit_2_2')} as lunchit_2_2, {clean('Eingereichter_Betrag')} as eingereichter_betrag,
       {clean('Erstattungsbetrag')} as erstattungsbetrag, {clean('Zuzahlung')} as zuzahlung,
       cast({clean('id')} as integer) as id,
       cast(strptime(nullif(Abrechnungsmonat, ''), '%d.%m.%Y') as date) as abrechnungsmonat,
       cast(strptime(nullif(Datum, ''), '%d.%m.%Y') as date) as datum
from lunchit_src""", "lunchit_src")

cte("lunchit_mapped", """
select l.*, m.email from lunchit l
left join (select distinct id, email from mapping where email is not null) m on l.id = m.id""",
    "lunchit", "mapping")

cte("lunchit_pay", """
select date, zuzahlung as amount, 'Benefit' as type, 'Lunchit' as name, factorial_id
from (select p.*, a.id as factorial_id
      from (select email, cast(date_trunc('month', abrechnungsmonat - interval 1 month) as date) as date,
                   coalesce(lunchit_1_2, 0) + coalesce(lunchit_2_2, 0) as zuzahlung
            from lunchit_mapped where abrechnungsmonat is not null) p
      join active a on p.email = a.email) x
where zuzahlung > 0""", "lunchit_mapped", "active")

_CV_T1 = ("'{\"11\": \"' || p_name || '\", \"12\": \"' || d1 || '\", \"13\": \"' || p_type || '\", \"14\": ' || "
          "case when p_partkey % 4 = 0 then 'null' else '\"' || d2 || '\"' end || ', \"15\": \"' || cents || "
          "'\", \"99\": \"x\"}'")
_CV_T2 = "'{\"21\": \"' || d1 || '\", \"22\": \"' || cents || '\"}'"
_CV_T3 = "'{\"31\": \"' || p_brand || '\"}'"

cte("custom_vals", f"""
select p_partkey as id, p_partkey as employee_id, table_id,
       case when table_id = 1 then {_CV_T1} when table_id = 2 then {_CV_T2} else {_CV_T3} end as raw
from (select *, cast(p_size % 3 + 1 as bigint) as table_id,
             strftime(DATE '2023-01-01' + cast(p_partkey % 365 as integer), '%Y-%m-%d') as d1,
             strftime(DATE '2023-01-01' + cast(p_partkey % 365 + p_size as integer), '%Y-%m-%d') as d2,
             cast((p_partkey * 7) % 100000 as varchar) as cents
      from part) p""")

cte("unpacked", """
select id, employee_id, table_id, cast(k as integer) as col_id, json_extract_string(raw, '$."' || k || '"') as val
from (select *, unnest(json_keys(raw)) as k from custom_vals) x""", "custom_vals")

cte("custom_tables", """select * from (values (1::bigint, 'Weiterbildung 2024'), (2::bigint, 'Inflationsausgleich'),
    (3::bigint, 'Sonstiges')) t(id, name)""")
cte("custom_cols", """select * from (values (11::bigint, 'Titel'), (12::bigint, 'Datum'), (13::bigint, 'Typ'),
    (14::bigint, 'Enddatum'), (15::bigint, 'Kosten'), (21::bigint, 'Datum'), (22::bigint, 'Betrag'),
    (31::bigint, 'Notiz')) t(id, label)""")

cte("mapped_custom", """
select u.id, u.employee_id as factorial_id, u.table_id, t.name as table_name, u.col_id, c.label as col_name, u.val
from unpacked u join custom_tables t on t.id = u.table_id join custom_cols c on c.id = u.col_id""",
    "unpacked", "custom_tables", "custom_cols")

LABELS = ["Betrag", "Datum", "Enddatum", "Kosten", "Notiz", "Titel", "Typ"]


def _pivot(pattern: str | None) -> str:
    cols = ", ".join(f"max(case when col_name = '{lab}' then val end) as \"{lab}\"" for lab in LABELS)
    where = f"where table_name like '%{pattern}%'" if pattern else ""
    return f"select factorial_id, id, {cols} from mapped_custom {where} group by factorial_id, id"


cte("pivot_all", _pivot(None), "mapped_custom")
cte("pivot_training", _pivot("Weiterbildung"), "mapped_custom")
cte("pivot_inflation", _pivot("Inflation"), "mapped_custom")

cte("inflation", """
select factorial_id, cast("Datum" as date) as date, 'Inflation' as type, 'Inflation' as name,
       cast(cast("Betrag" as integer) // 100 as integer) as amount
from pivot_inflation""", "pivot_inflation")

cte("trainings", """
select factorial_id, "Titel" as title, cast("Datum" as date) as date, "Typ" as type,
       coalesce(cast("Enddatum" as date), cast("Datum" as date)) as end_date,
       cast(cast("Kosten" as integer) // 100 as integer) as cost
from pivot_training""", "pivot_training")

cte("payments_union", """
select factorial_id, cast(amount as double) as amount, date, type, name from salary
union all select factorial_id, cast(amount as double), date, type, name from lunchit_pay
union all select factorial_id, cast(amount as double), date, type, name from inflation
union all select factorial_id, cast(amount as double), date, type, name from benefit""",
    "salary", "lunchit_pay", "inflation", "benefit")

cte("payments", """
select a.factorial_id, a.amount, a.date, a.type, a.name, g.average_amount
from (select *, cast(date_trunc('month', date) as date) as month from payments_union) a
left join (select month, type,
                  cast(sign(t) * ((200 * abs(t) + 100000000 * n) // (200000000 * n)) / 100.0 as decimal(20,2)) as average_amount
           from (select month, type, cast(sum(s) as hugeint) as t, count(*) as n
                 from (select cast(date_trunc('month', date) as date) as month, type, factorial_id,
                              sum(cast(cast(amount as decimal(20,8)) * 100000000 as hugeint)) as s
                       from payments_union group by all) p
                 group by month, type) q) g
  on a.month = g.month and a.type = g.type""", "payments_union")

# ---------------------------------------------------------------- time tracking
cte("troi_src", f"""
select case when event_type = 'signup' then 'Summe' else strftime(ts, '%Y-%m-%d') || ' 00:00:00' end as Monat,
       strftime(ts, '%H:%M') as Checked_In, '' as Checked_Out,
       case when event_type = 'click' then b1 || chr(10) || b2 when event_type = 'purchase' then '' else b1 end
           as Pausenzeiten,
       case when event_type = 'view' then ''
            when event_type = 'error' then printf('%d:%02d', cast(v % 10 as integer), minute(ts))
            else printf('%02d:%02d', cast(v % 12 as integer), minute(ts)) end as Arbeitszeit,
       {comma('value')} as erfasste_Stunden,
       case when v % 3 = 0 then cast(v % 2 as varchar) || ',50 / ' || cast(v % 9 as varchar) || ',00' else '' end
           as Urlaub__PT___Std__,
       case when event_type = 'error' then cast(v % 2 as varchar) || case when v % 4 = 0 then ',50' else ',00' end
            || ' / ' || cast(v % 9 as varchar) || ',00' else '' end as krank__PT___Std__,
       case when v % 7 = 0 then '1,00 / 10,00' else '' end as Kurzarbeit__PT___Std__,
       case when v % 13 = 0 then '5,00'
            else cast(v % 3 as varchar) || ',00 / ' || cast(v % 9 + 2 as varchar) || ',50' end
           as Abwesenheiten__PT___Std__,
       '' as Gesamt, cast(v % 4 as varchar) || ',25' as WB, cast(v % 2 as varchar) || ',5' as NWB,
       '' as wb_nwb, '' as an_ab, case when event_type = 'view' then '' else '8,00' end as Soll, '' as Saldo,
       cast(user_id as varchar) || '.0' as id
from (select *, cast(floor(value) as bigint) as v, hour(ts) * 60 + minute(ts) as st,
             printf('%02d:%02d - %02d:%02d', (hour(ts) * 60 + minute(ts)) // 60, (hour(ts) * 60 + minute(ts)) % 60,
                    ((hour(ts) * 60 + minute(ts) + cast(floor(value) as bigint) % 50) % 1440) // 60,
                    ((hour(ts) * 60 + minute(ts) + cast(floor(value) as bigint) % 50) % 1440) % 60) as b1,
             printf('%02d:%02d - %02d:%02d', ((hour(ts) * 60 + minute(ts) + 60) % 1440) // 60,
                    ((hour(ts) * 60 + minute(ts) + 60) % 1440) % 60,
                    ((hour(ts) * 60 + minute(ts) + 75) % 1440) // 60,
                    ((hour(ts) * 60 + minute(ts) + 75) % 1440) % 60) as b2
      from events) e""")

cte("troi", f"""
select * from (
  select Monat as monat, Checked_In as checked_in, Checked_Out as checked_out, Pausenzeiten as pausenzeiten,
         Arbeitszeit as arbeitszeit, {clean('erfasste_Stunden')} as erfasste_stunden,
         Urlaub__PT___Std__ as urlaub, krank__PT___Std__ as krank, Kurzarbeit__PT___Std__ as kurzarbeit,
         Abwesenheiten__PT___Std__ as abwesenheiten, {clean('Gesamt')} as gesamt, {clean('WB')} as wb,
         {clean('NWB')} as nwb, {clean('wb_nwb')} as wb_nwb, {clean('an_ab')} as an_ab, {clean('Soll')} as soll,
         {clean('Saldo')} as saldo, cast(split_part(id, '.', 1) as integer) as id
  from troi_src) x
where monat <> '' and coalesce(regexp_matches(monat, '^\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}$'), false)""",
    "troi_src")

cte("troi_mapped", """
select t.*, m.troi_name from troi t
left join (select distinct id, troi_name from mapping where troi_name is not null) m on t.id = m.id""",
    "troi", "mapping")

cte("iwh", f"""
select pausenzeiten as break_time_period, urlaub as paid_absence, krank as sick_leave, kurzarbeit as short_working,
       abwesenheiten as absence_time, wb, nwb, soll as planned_amount, troi_name, cast(monat as date) as date,
       {hhmm_hours('arbeitszeit')} as industrial_working_hours
from troi_mapped""", "troi_mapped")


def _minutes(x: str) -> str:
    return (f"(cast(split_part(nullif(trim({x}), ''), ':', 1) as integer) * 60 "
            f"+ cast(split_part(nullif(trim({x}), ''), ':', 2) as integer))")


cte("breaks", f"""
select date, troi_name, cast(sum({hhmm_hours('hhmm')}) as decimal(16,2)) as break_amount
from (select date, troi_name,
             case when m >= 0 and m < 6000 then printf('%02d:%02d', m // 60, m % 60) end as hhmm
      from (select date, troi_name,
                   {_minutes("trim(split_part(brk, '-', 2))")} - {_minutes("trim(split_part(brk, '-', 1))")} as m
            from (select date, troi_name, trim(v) as brk
                  from (select date, troi_name, unnest(string_split(break_time_period, chr(10))) as v from iwh) s
                  where v <> '') a) b) c
group by date, troi_name""", "iwh")


def _pair(col: str, name: str) -> str:
    n = f"(position('/' in {col}) - 1)"
    return (f"{clean(f'right({col}, {n})')} as {name}_hours, {clean(f'left({col}, {n})')} as {name}_mandays")


cte("cleaned", f"""
select date, break_time_period, {_pair('paid_absence', 'paid_absence')}, {_pair('sick_leave', 'sick_leave')},
       {_pair('short_working', 'short_working')}, {_pair('absence_time', 'absence_time')},
       wb, nwb, planned_amount, troi_name, industrial_working_hours
from iwh""", "iwh")

cte("absences", """
select date, full_name, absence_type, duration_hours, duration_mandays from (
  select date, troi_name as full_name, 'Urlaub' as absence_type, paid_absence_hours as duration_hours,
         paid_absence_mandays as duration_mandays, 1 as o from x
  union all select date, troi_name, 'Krank', sick_leave_hours, sick_leave_mandays, 2 from x
  union all select date, troi_name, 'Kurzarbeit', short_working_hours, short_working_mandays, 3 from x
  union all select date, troi_name, 'Anderes', oh, od, 4 from x) u
where duration_hours is not null and duration_hours > 0""", "x")

cte("x", """
select *, coalesce(absence_time_hours, 0) - (coalesce(paid_absence_hours, 0) + coalesce(sick_leave_hours, 0)
                                             + coalesce(short_working_hours, 0)) as oh,
          coalesce(absence_time_mandays, 0) - (coalesce(paid_absence_mandays, 0) + coalesce(sick_leave_mandays, 0)
                                               + coalesce(short_working_mandays, 0)) as od
from cleaned""", "cleaned")

cte("islands", """
select s + cast(greatest(isodow(s) - 5, 0) * (8 - isodow(s)) / greatest(isodow(s) - 5, 1) as integer) as interval_start_date,
       e - cast(greatest(isodow(e) - 5, 0) as integer) as interval_end_date,
       consecutive_days
from (select min(date) as s, max(date) as e,
             cast(1 + datediff('day', min(date), max(date)) - sum(wk) as bigint) as consecutive_days, full_name
      from (select full_name, date, date - cast(rnk as integer) as grp, case when isodow(date) > 5 then 1 else 0 end as wk
            from (select full_name, date, rank() over (partition by full_name order by date) as rnk
                  from (select troi_name as full_name, date,
                               case when isodow(date) > 5 then 1 else sick_leave_mandays end as m
                        from cleaned) f
                  where m is not null) r) g
      group by full_name, grp) i
where consecutive_days > 0""", "cleaned")

cte("working", """
select date, troi_name as full_name, industrial_working_hours as worked_amount, break_amount, planned_amount,
       cast(round(cast(coalesce(coalesce(industrial_working_hours, 0) + coalesce(absence_time_hours, 0), 0)
                       - coalesce(planned_amount, 0) as decimal(38,15)), 2) as decimal(20,2)) as difference,
       wb, nwb, legal as legal_break_time,
       if(legal is null, null, if(coalesce(break_amount, 0) >= legal, 'O', 'X')) as compliance_break_time
from (select c.*, b.break_amount,
             cast(case when industrial_working_hours <= 6 then 0 when industrial_working_hours <= 9 then 0.5
                       when industrial_working_hours > 9 then 0.75 end as decimal(3,2)) as legal
      from cleaned c left join breaks b on c.troi_name = b.troi_name and c.date = b.date) j
where coalesce(industrial_working_hours, 0) + coalesce(break_amount, 0) + coalesce(planned_amount, 0)
      + coalesce(wb, 0) + coalesce(nwb, 0) + coalesce(absence_time_hours, 0) > 0""", "cleaned", "breaks")

cte("pto", """
select n.year, n.troi_name as full_name, n.amount, n.rest_amount_previous_year, coalesce(t.taken_pto, 0) as taken_pto
from (select nm.troi_name, pto.jahr as year, pto.urlaubsanspruch_pt as amount,
             pto.resturlaub_vorjahr as rest_amount_previous_year
      from mapping nm join mapping pto on nm.id = pto.id
      where nm.troi_name is not null and pto.jahr is not null) n
full join (select troi_name, cast(date_trunc('year', date) as date) as year, sum(paid_absence_mandays) as taken_pto
           from cleaned group by troi_name, cast(date_trunc('year', date) as date)) t
  on n.troi_name = t.troi_name and n.year = t.year
where n.year is not null and n.troi_name is not null""", "mapping", "cleaned")


cte("name_mapping_dim", "select email, troi_name from mapping where troi_name is not null", "mapping")
cte("mood", """
select cast(strftime(o_orderdate, '%Y-%m-%d') as date) as date, cast(left(o_orderpriority, 1) as integer) as rating,
       case when o_orderkey % 3 = 0 then o_orderstatus end as feedback,
       case when o_orderkey % 5 = 0 then 'zu laut' end as feedback_bad_rating,
       case when o_orderkey % 3 <> 0 and o_orderkey % 5 <> 0 then 0 else 1 end as feedback_exists
from orders""")
cte("mood_answers", """
select cast(o_orderkey as varchar) as response_id, cast(strftime(o_orderdate, '%Y-%m-%d') as date) as date,
       o_orderpriority as rating from orders""")
cte("teams_src", """
select cast(c_nationkey * 1000000 + c_custkey // 100 as bigint) as id,
       'Team ' || cast(c_nationkey as varchar) || '-' || cast(c_custkey // 100 as varchar) as name
from customer group by c_nationkey, c_custkey // 100""")
cte("teams_full", """
select null::bigint as company_id, cast(c_nationkey * 1000000 + c_custkey // 100 as bigint) as id,
       'Team ' || cast(c_nationkey as varchar) || '-' || cast(c_custkey // 100 as varchar) as name,
       string_agg(cast(c_custkey as varchar), ',' order by c_custkey) as employee_ids, null::varchar as lead_ids,
       null::varchar as description, 'team-' || cast(c_custkey // 100 as varchar) || '.png' as avatar
from customer group by c_nationkey, c_custkey // 100""")
cte("teams_dim", """
select 'Team ' || cast(c_nationkey as varchar) || '-' || cast(c_custkey // 100 as varchar) as team_name,
       cast(c_custkey as integer) as factorial_id
from customer""")
cte("custom_vals_model", "select id, employee_id, raw as col_val, table_id from custom_vals", "custom_vals")


def sql(final: str, *needed: str) -> str:
    """Assemble ``WITH`` + ``final`` including all transitive dependencies in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + final
