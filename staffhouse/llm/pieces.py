"""Cutting texts into units that a byte-level BPE pre-tokenizer treats independently."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARKS = ".,;:!?"


def _starts(x: str) -> bool:
    """A letter or a printable ASCII character comes first: certainly no white space."""
    return "!" <= x[0] <= "~" or x[0].isalpha()


def _add(out: list[str], x: str) -> None:
    word = x.rstrip(MARKS)
    if len(word) < len(x) and word and word[-1].isalpha():
        out.append(word)
        out.append(x[len(word):])
    else:
        out.append(x)


def _add_lines(out: list[str], x: str) -> None:
    lines = x.split("\n")
    if lines[0] and lines[0].rstrip() == lines[0] and all(p and p.strip() == p and _starts(p) for p in lines[1:]):
        _add(out, lines[0])
        for p in lines[1:]:
            out.append("\n")
            _add(out, p)
    else:
        out.append(x)


def units(text: str) -> list[str]:
    """Cut where the pre-tokenizer pattern always ends a match, so that units can be split, encoded
    and remembered alone:

    * before a space followed by a letter or a printable ASCII character: a single space goes to the
      word after it, and of a longer run of white space all but the last character are a match;
    * around a line feed between characters that are no white space: it is a match of its own;
    * between a letter and the marks after it: letters only match with letters."""
    first, *rest = text.split(" ")
    out: list[str] = []
    if "\n" in first:
        _add_lines(out, first)
    elif first:
        _add(out, first)
    add = out.append
    for x in rest:
        if x and ((c := x[0]).isalpha() or "!" <= c <= "~"):
            if "\n" in x:
                _add_lines(out, " " + x)
            elif x[-1] in MARKS:
                _add(out, " " + x)
            else:
                add(" " + x)
        elif out:
            out[-1] += " " + x
        else:
            add(" " + x)
    return out


LINE_FEED = "\x00"       # stands for it while texts are split at spaces
#: A piece after a space or a line feed is certainly cut there as well when it is split as a whole text is, if it
#: begins with a letter or a printable ASCII character and ends without white space.
PLAIN = r"^\x00?[!-~\pL]"


@dataclass
class Pieces:
    """Texts split at spaces and line feeds, their distinct pieces numbered."""
    offsets: np.ndarray         # text i has the pieces offsets[i] to offsets[i + 1], its head first
    at: np.ndarray              # number of each piece; that of a head means nothing
    text: list[str]             # of each number with ``plain``, with the space or line feed before it
    plain: np.ndarray           # which numbers may be taken alone
    heads: list[str]            # what each text has before its first space or line feed
    slow: np.ndarray            # texts with a piece that might not be independent: cut these by ``units``


def split(texts: pa.Array, apart: pa.Array | None = None) -> Pieces:
    """Pieces of all texts, split and numbered in Arrow, so that Python only meets the distinct ones. Texts of ``apart`` are
    among the slow ones."""
    own = pc.match_substring(texts, LINE_FEED)
    own = own if apart is None else pc.or_(own, apart)
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " " + LINE_FEED), " ")
    offsets = lists.offsets.to_numpy()
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = offsets - offsets[0]
    at, distinct = coded.indices.to_numpy(), coded.dictionary
    plain = pc.and_(pc.match_substring_regex(distinct, PLAIN), pc.equal(pc.utf8_rtrim_whitespace(distinct), distinct))
    whole = pc.if_else(pc.starts_with(distinct, LINE_FEED), pc.replace_substring(distinct, LINE_FEED, "\n", max_replacements=1),
                       pc.binary_join_element_wise(pa.scalar(""), distinct, pa.scalar(" ")))
    is_plain = plain.to_numpy(zero_copy_only=False)
    first = offsets[:-1]
    heads = distinct.take(pa.array(at[first])).to_pylist()
    bad = ~is_plain[at]
    bad[first] = [h[-1:].isspace() for h in heads]
    slow = own.to_numpy(zero_copy_only=False) | (np.add.reduceat(bad, first, dtype=np.int64) > 0)
    return Pieces(offsets, at, whole.filter(plain).to_pylist(), is_plain, heads, slow)
