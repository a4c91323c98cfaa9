"""Secret scan: single-pattern findings, and weak candidates linked into multipart credentials."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kind -> (pattern, group whose length counts, least length); all native to the regular expressions of the JVM.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
# Weak parts, reported only next to what completes them.  No pattern repeats a group over the text: the regular
# expressions of the JVM would recurse once a repetition.
IDENTIFIER = (r"(?:(?<![A-Z0-9])(?:ASIA|AIDA|AROA|AGPA)[A-Z0-9]{8,}"
              r"|(?i:client_?id|access_?key_?id|account_?id|user_?name|login)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,})")
SECRET = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])"
          r"[A-Za-z0-9+/_=-]{16,}+(?![A-Za-z0-9+/_=-])")
ENDPOINT = (r"(?:(?i:https?|wss?|amqps?|postgres(?:ql)?|mysql|redis|mongodb)://[A-Za-z0-9][^\s\"'<>]*+"
            r"|(?<![A-Za-z0-9.-])[a-z0-9-][a-z0-9.-]*+:[0-9]{2,5}+(?![0-9]))")
#: A host with a port has at least two labels and no empty one.
HOST = r"^(?:[a-z0-9-]++\.)[a-z0-9.-]*+:[0-9]+$"
EMPTY_LABEL = r"\.\.|\.:"
WEAK = ("key_id", "weak_secret", "endpoint")
#: Parts of one credential lie at most this many characters apart.
SCOPE_CHARS = 200

_SPANS = "array<struct<start:int,kind:int,end:int,role:int>>"
_NONE = "cast(array() as " + _SPANS + ")"
#: Roles of parts in a credential.
_ID, _SECRET, _PLACE = 0, 1, 2
#: Spans are swept in blocks, so that arrays grown step by step stay short.
BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sweep(items: Column, zero: Column, step: Callable, merge: Callable, emit: Callable, kind: str) -> Column:
    """``emit(state, item)`` for each item in order, the state being ``step`` over the items before it.

    Blocks are summed up first (``merge`` joins the sums of neighbouring runs), then each block is swept from its
    first state: the cost is linear in the items, where one array grown item by item would be copied each time.
    """
    nothing, states = F.expr(f"cast(array() as {kind})"), F.slice(F.array(zero), 1, 0)

    def blocked(values: Column) -> Column:
        blocks = F.when(F.size(values) > 0, F.transform(
            F.sequence(F.lit(0), F.size(values) - 1, F.lit(BLOCK)), lambda at: F.slice(values, at + 1, BLOCK)))
        return _let(blocks, lambda b: F.flatten(F.zip_with(b, firsts(b), one)))

    def firsts(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, zero, step))
        return F.aggregate(sums, F.struct(zero.alias("at"), states.alias("out")), lambda s, total: F.struct(
            merge(s.at, total).alias("at"), F.concat(s.out, F.array(s.at)).alias("out"))).out

    def one(block: Column, first: Column) -> Column:
        return F.aggregate(block, F.struct(first.alias("at"), nothing.alias("out")), lambda s, item: F.struct(
            step(s.at, item).alias("at"), F.concat(s.out, F.array(emit(s.at, item))).alias("out"))).out

    return F.coalesce(_let(items, blocked), nothing)        # of no items, or null


class _Steps:
    """Columns derived one after the other under names no table has; each is read outside of lambdas or through
    ``_let``, so nothing is derived anew for every element."""

    def __init__(self, rows: DataFrame):
        self.rows, self.prefix, self.names = rows, f"step_{uuid.uuid4().hex}_", []

    def put(self, value: Column) -> Column:
        name = f"{self.prefix}{len(self.names)}"
        self.names.append(name)
        self.rows = self.rows.withColumn(name, value)
        return F.col(name)


def _spans(steps: _Steps, text: Column, pattern: str, kind: int, role: int, group: int = 0, least: int = 0,
           when: Column | None = None, good: Callable[[Column], Column] | None = None) -> Column:
    """Spans of a pattern, in code points: the pieces between the matches give the offsets."""
    regex = F.lit(pattern)
    has = text.rlike(pattern) if when is None else when & text.rlike(pattern)
    matches = F.zip_with(F.regexp_extract_all(text, regex, F.lit(0)), F.regexp_extract_all(text, regex, F.lit(group)),
                         lambda m, g: F.struct(F.length(m).alias("n"), (
                             (F.length(g) >= least) & (F.lit(True) if good is None else good(m))).alias("ok")))
    parts = steps.put(F.when(has, _let(matches, lambda found: F.struct(found.alias("found"), F.size(found).alias("n")))))
    parts = steps.put(F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.coalesce(parts.n, F.lit(0))), parts.found,
                                 lambda p, m: F.struct(F.length(p).alias("gap"), m.n.alias("n"), m.ok.alias("ok"))))
    spans = steps.put(_sweep(
        parts, F.lit(0), lambda at, m: at + m.gap + m.n, lambda at, total: at + total,
        lambda at, m: F.struct((at + m.gap).alias("start"), F.lit(kind).alias("kind"), (at + m.gap + m.n).alias("end"),
                               F.lit(role).alias("role"), m.ok.alias("ok")),
        "array<struct<start:int,kind:int,end:int,role:int,ok:boolean>>"))
    return steps.put(F.transform(F.filter(spans, lambda s: s.ok), lambda s: F.struct(
        s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end"), s.role.alias("role"))))


def _beside(steps: _Steps, spans: Column, groups: list[Callable[[Column], Column]], kept: Callable) -> Column:
    """Spans (in order) for which ``kept(span, ends, starts)`` holds.

    ``ends`` are, for each group, the largest end of its spans before this one in order, ``starts`` the least start of
    those behind it; groups are conditions on a span.
    """
    far = 1 << 29
    names = [f"g{i}" for i in range(len(groups))]

    def state(values: list[Column]) -> Column:
        return F.struct(*[v.alias(n) for n, v in zip(names, values)])

    def swept(items: Column, value: Callable[[Column], Column], pick: Callable, none: int) -> Column:
        """The best value of each group among the items before each item."""
        step = lambda at, s: state([F.when(g(s), pick(at[n], value(s))).otherwise(at[n]) for g, n in zip(groups, names)])
        merge = lambda at, total: state([pick(at[n], total[n]) for n in names])
        return steps.put(_sweep(items, state([F.lit(none)] * len(groups)), step, merge, lambda at, s: at,
                                f"array<struct<{','.join(f'{n}:int' for n in names)}>>"))

    ends = swept(spans, lambda x: x.end, F.greatest, -far)
    starts = swept(F.reverse(spans), lambda x: x.start, F.least, far)
    around = steps.put(F.zip_with(ends, F.reverse(starts), lambda e, f: F.struct(e.alias("e"), f.alias("f"))))
    rows = steps.put(F.zip_with(spans, around, lambda x, y: F.struct(x.alias("s"), y.e.alias("e"), y.f.alias("f"))))
    good = F.filter(rows, lambda r: kept(r.s, [r.e[n] for n in names], [r.f[n] for n in names]))
    return steps.put(F.transform(good, lambda r: r.s))


def scan(docs: DataFrame, text: str = "text", *, scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """Adds ``base`` and ``linked`` (arrays of ``start, kind, end``; code points, end exclusive) to every row.

    Existing columns of these names are replaced, all others stay.  ``base`` holds the matches of the three single
    patterns, leftmost and without overlap per kind, short ones dropped.  ``linked`` holds weak candidates: an
    identifier counts only with a secret in its scope, a bare random string only with an identifier, an endpoint only
    with both.  Strong findings serve as parts too (``access`` as identifier, ``assign`` and ``hex`` as secrets), and
    what overlaps them is not reported again.  The scope is ``scope_chars`` to either side.

    Everything happens inside the row: both sides of the interval join are the row's spans in order, swept once
    forward and once backward, so the work is linear in the text and its findings (but for sorting them) and nothing
    is shuffled.  Patterns for weak parts run only where an identifier was found.  A null or empty text has no spans.
    """
    steps = _Steps(docs)
    t = steps.put(F.coalesce(F.col(text), F.lit("")))
    roles = {"assign": _SECRET, "access": _ID, "hex": _SECRET}
    is_base, is_id, is_secret = (lambda s: s.kind < len(BASE)), (lambda s: s.role == _ID), (lambda s: s.role == _SECRET)
    crossed = lambda s, end, start: (end > s.start) | (start < s.end)
    host = lambda m: m.contains("://") | (m.rlike(HOST) & ~m.rlike(EMPTY_LABEL))

    base = steps.put(F.array_sort(F.concat(*[_spans(steps, t, p, k, roles[name], g, least)
                                             for k, (name, (p, g, least)) in enumerate(BASE.items())])))
    ids = _spans(steps, t, IDENTIFIER, 3, _ID)
    held = steps.put((F.size(ids) > 0) | F.exists(base, is_id))
    bare = _spans(steps, t, SECRET, 4, _SECRET, when=held)
    # an identifier that looks random is not its own secret
    weak = _beside(steps, steps.put(F.array_sort(F.concat(ids, bare))), [is_id],
                   lambda s, e, b: is_id(s) | ~crossed(s, e[0], b[0]))
    both = steps.put(held & (F.exists(weak, is_secret) | F.exists(base, is_secret)))
    places = _spans(steps, t, ENDPOINT, 5, _PLACE, when=both, good=host)
    every = steps.put(F.when(both, F.array_sort(F.concat(base, weak, places))).otherwise(F.expr(_NONE)))
    apart = _beside(steps, every, [is_base], lambda s, e, b: is_base(s) | ~crossed(s, e[0], b[0]))

    def complete(s: Column, e: list[Column], b: list[Column]) -> Column:
        near = [(s.start - e[r] <= scope_chars) | (b[r] - s.end <= scope_chars) for r in (_ID, _SECRET)]
        needed = F.when(is_id(s), near[_SECRET]).when(is_secret(s), near[_ID]).otherwise(near[_ID] & near[_SECRET])
        return ~is_base(s) & needed

    linked = _beside(steps, apart, [is_id, is_secret], complete)
    strip = lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end"))
    return steps.rows.withColumns({"base": F.transform(base, strip), "linked": F.transform(linked, strip)}).drop(*steps.names)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined, by start and then kind as listed."""
    names = F.array(*[F.lit(n) for n in (*BASE, *WEAK)])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == [*BASE, *WEAK].index(kind))).cast("long")
