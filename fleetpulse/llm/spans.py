"""Spans of a pattern in whole texts, with SQL functions only.

``regexp_extract_all`` gives the matches and ``split`` the gaps between them;
running sums of their lengths, in parts, give each match's start.  Positions count code
points and ends are exclusive.  Java runs possessive groups in a loop, so the
patterns use them where nothing could follow; long runs then need no stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
NONE = f"CAST(array() AS {SPAN})"


def literal(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bound(value: str, name: str, result: str) -> str:
    """SQL of ``result``, in which ``name`` stands for ``value``, made once."""
    return f"get(transform(array({value}), {name} -> {result}), 0)"


def chunked(items: str, start: str, kind: str, step: str) -> str:
    """SQL that folds an array in parts of about the square root of its size.

    A fold that appends to an array copies it at each step; with parts, ``n``
    steps copy about ``n`` times the square root of ``n`` places, not the square
    of ``n``.  ``step`` gives the next state from ``a`` (``at`` and ``out``, an
    array of ``kind``) and an item ``x``; ``start`` is the first ``at``.
    """
    none = f"CAST(array() AS array<{kind}>)"
    part = f"aggregate(slice(t, k * c + 1, c), named_struct('at', p.at, 'out', {none}), (a, x) -> {step})"
    whole = (f"aggregate(sequence(0, CAST((greatest(size(t), 1) - 1) DIV c AS int)), "
             f"named_struct('at', {start}, 'out', CAST(array() AS array<array<{kind}>>)), "
             f"(p, k) -> {bound(part, 'f', 'named_struct(' + repr('at') + ', f.at, ' + repr('out') + ', concat(p.out, array(f.out)))')}, "
             "p -> flatten(p.out))")
    return bound(items, "t", bound("CAST(greatest(1, ceil(sqrt(size(t)))) AS int)", "c", whole))


def starts(items: str) -> str:
    """SQL for the start of each of an array of structs of ``gap`` (the length
    before it) and ``size``."""
    return chunked(items, "0", "int", "named_struct('at', a.at + x.gap + x.size, 'out', "
                                      "concat(a.out, array(a.at + x.gap)))")


def spans(column: str, kind: str, pattern: str, keep: Callable[[str], str] | None = None,
          needs: str | None = None) -> str:
    """SQL for all leftmost non-overlapping matches of ``pattern`` in a column,
    as structs of kind, start, end and value.

    ``keep`` gives the SQL condition that a matched text (``x.value``) must
    meet.  ``needs`` is a plain text every match contains: texts without it
    skip the pattern.
    """
    p = literal(pattern)
    sizes = "transform(m, (v, i) -> named_struct('gap', length(get(g, i)), 'size', length(v)))"
    placed = (f"zip_with(m, {starts(sizes)}, (v, s) -> named_struct('kind', '{kind}', 'start', s, "
              "'end', s + length(v), 'value', v))")
    some = bound(f"split({column}, {p}, -1)", "g", placed)
    made = bound(f"regexp_extract_all({column}, {p}, 0)", "m", f"CASE WHEN size(m) = 0 THEN {NONE} ELSE {some} END")
    if keep:
        made = f"filter({made}, x -> {keep('x.value')})"
    return f"CASE WHEN contains({column}, {literal(needs)}) THEN {made} ELSE {NONE} END" if needs else made


def masked(column: str, marks: str) -> str:
    """SQL for a text with the spans of ``marks`` (sorted structs of ``start``,
    ``end`` and ``mark``) replaced.  Spans that overlap go as one, with the
    first one's mark.  The text is cut in parts first, as finding a place in it
    takes time in proportion to the place."""
    # the marks that stay, and where the text goes on before each
    apart = chunked(marks, "0", "struct<at:int,start:int,mark:string>",
                    "named_struct('at', greatest(a.at, x.end), 'out', CASE WHEN x.start >= a.at "
                    "THEN concat(a.out, array(named_struct('at', a.at, 'start', x.start, 'mark', x.mark))) "
                    "ELSE a.out END)")
    each = ("array_join(transform(own, x -> concat(substring(part, x.at - own[0].at + 1, x.start - x.at), x.mark)), '')")
    cut = bound(f"substring({column}, own[0].at + 1, element_at(own, -1).start - own[0].at)", "part", each)
    block = bound("slice(t, k * c + 1, c)", "own", cut)
    last = f"array_max(transform({marks}, m -> m.end))"
    joined = (f"concat(array_join(transform(sequence(0, CAST((size(t) - 1) DIV c AS int)), k -> {block}), ''), "
              f"substring({column}, {last} + 1))")
    return bound(apart, "t", f"CASE WHEN size(t) = 0 THEN {column} ELSE "
                 + bound("CAST(greatest(1, ceil(sqrt(size(t)))) AS int)", "c", joined) + " END")


def listed(found: str) -> Column:
    """kind:start:end of each span of an array, comma-joined, in its order."""
    return F.expr(f"array_join(transform({found}, x -> concat_ws(':', x.kind, CAST(x.start AS string), "
                  "CAST(x.end AS string))), ',')")
