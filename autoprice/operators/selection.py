"""Exact cuts of a total order by radix selection.

``segments`` numbers every row by how many of some ranks lie at or before it in key order (exact samples and splits,
time-ordered segments, contiguous folds). It never sorts or shuffles the rows: what it needs is the key at each rank, and
those are found by counting.

1. One aggregate over the key's first column: rows, smallest and largest value (skipped where the bounds are known, as for hash draws).
2. A histogram of the leading DIGIT bits in which the values differ (of two bytes, for text): at most 2^DIGIT counts
   a cut. Only the buckets that hold a cut are looked at further, all of them in the same pass.
3. A bucket of at most LEAF rows is read, key columns only, and its keys at the wanted ranks are taken. A larger one is counted by
   its next bits, or by the next key column once its rows share one value.

n rows need about log(n / LEAF) / log(2^DIGIT) histograms, so two for 10^12 evenly spread keys; then
each row is compared with the cut keys where it stands. Passes read the key columns only. They read the input again, so
it must give the same rows each time; write a table first where that is costly or not so.

Nulls come first, as in ascending sort order. Columns with a digit form are integers, booleans, dates, timestamps and text;
others, and keys that repeat at a cut (where no key tells its rows apart), are ranked by ``ranking.global_index``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autoprice.operators.ranking import global_index

DIGIT = 16
LEAF = 1 << 16
_SIGN = -(1 << 63)


class NotUnique(Exception):
    """The key repeats at a cut."""


@dataclass
class _Node:
    """Rows that share their first ``depth`` key columns with ``fixed`` and lie from ``low`` to ``high`` (None: not known)
    in the next; ``before`` rows come before them, and they hold the ranks ``ranks``."""
    fixed: list
    count: int | None
    before: int
    ranks: list[int]
    low: object = None
    high: object = None
    null: bool = False   # all null in the next column
    mixed: bool = False  # some of them

    @property
    def depth(self) -> int:
        return len(self.fixed)


def digit_form(df: DataFrame, cols: list[Column]) -> list[Column] | None:
    """The key columns as bigints or text in the same order, or None where one has no such form."""
    out = []
    for c, f in zip(cols, df.select(*cols).schema.fields):
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            out.append(c.cast("bigint"))
        elif isinstance(f.dataType, T.BooleanType):
            out.append(c.cast("int").cast("bigint"))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.unix_date(c).cast("bigint"))
        elif isinstance(f.dataType, T.TimestampType):
            out.append(F.unix_micros(c))
        elif isinstance(f.dataType, T.StringType):
            out.append(c)
        else:
            return None
    return out


def _equal(c: Column, v) -> Column:
    return c.isNull() if v is None else F.coalesce(c == F.lit(v), F.lit(False))


def less(cols: list[Column], key: tuple) -> Column:
    """Whether a row's key comes before ``key`` (nulls first)."""
    out = F.lit(False)
    for c, v in reversed(list(zip(cols, key))):
        before = F.lit(False) if v is None else F.coalesce(c < F.lit(v), F.lit(True))
        out = before | (_equal(c, v) & out)
    return out


def _inside(node: _Node, cols: list[Column]) -> Column:
    parts = [_equal(c, v) for c, v in zip(cols, node.fixed)]
    if node.depth < len(cols):
        c = cols[node.depth]
        if node.null:
            parts.append(c.isNull())
        elif node.low is not None:
            parts.append(F.coalesce(c.between(F.lit(node.low), F.lit(node.high)), F.lit(node.mixed)))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _digit(node: _Node, c: Column) -> Column:
    """The leading digit in which the node's values differ; -1 for null."""
    if isinstance(node.low, str):
        low, high = node.low.encode(), node.high.encode()
        same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        two = F.substring(c.cast("binary"), same + 1, 2)
        d = F.conv(F.rpad(F.hex(two), 4, "0"), 16, 10).cast("bigint") * 3 + F.octet_length(two)
    else:
        width = (int(node.low) ^ int(node.high)).bit_length()  # of two's complement: a change of sign shows in every bit
        if (node.low < 0) != (node.high < 0):
            width = 64
        d = F.shiftrightunsigned(c.bitwiseXOR(F.lit(_SIGN)), max(width - DIGIT, 0)).bitwiseAND(F.lit((1 << DIGIT) - 1))
    return F.coalesce(d, F.lit(-1))


class Selection:
    """The order of ``df`` by ``cols`` (digit forms). ``bounds``: known bounds of the first column, without nulls."""

    def __init__(self, df: DataFrame, cols: list[Column], bounds: tuple[int, int] | None = None, leaf: int | None = None) -> None:
        self._names = [f"_k{i}" for i in range(len(cols))]
        self._keys = df.select(*[c.alias(n) for c, n in zip(cols, self._names)])
        self._cols = [F.col(n) for n in self._names]
        self._leaf = LEAF if leaf is None else leaf
        self._first = _Node([], None, 0, [], *(bounds or (None, None)))
        self._histogram: dict | None = None
        if bounds is None:
            self._bound([self._first])
            self.n = self._first.count
        else:  # the first histogram counts the rows, too
            self._histogram = self._count([self._first])
            self.n = sum(c for _, c, *_ in self._histogram.get(0, []))

    def _tagged(self, nodes: list[_Node], *more: Column) -> DataFrame:
        """The rows inside any of ``nodes``, with the node's number ``_node``."""
        tag = F.lit(None).cast("int")
        for i, n in reversed(list(enumerate(nodes))):
            tag = F.when(_inside(n, self._cols), i).otherwise(tag)
        return self._keys.select("*", tag.alias("_node")).where(F.col("_node").isNotNull())

    def _bound(self, nodes: list[_Node]) -> None:
        """Count, smallest and largest value of each node's next column."""
        for n in nodes:  # one aggregate without groups each: smallest and largest texts need no sort so
            c = self._cols[n.depth]
            r = self._keys.where(_inside(n, self._cols)).agg(F.count(F.lit(1)), F.count(c), F.min(c), F.max(c)).first()
            n.count, n.low, n.high = r[0], r[2], r[3]
            n.null, n.mixed = r[1] == 0, 0 < r[1] < r[0]

    def _count(self, nodes: list[_Node]) -> dict[int, list[tuple]]:
        """Per node: (digit, rows, smallest, largest) in order of the digit; the latter two for integers only."""
        d = self._tagged(nodes)
        digit, value = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
        for i, n in enumerate(nodes):
            c = self._cols[n.depth]
            digit = F.when(F.col("_node") == i, _digit(n, c)).otherwise(digit)
            if not isinstance(n.low, str):
                value = F.when(F.col("_node") == i, c).otherwise(value)
        rows = (d.select("_node", digit.alias("_d"), value.alias("_v")).groupBy("_node", "_d")
                .agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("l"), F.max("_v").alias("h")).collect())
        out: dict[int, list[tuple]] = {}
        for r in sorted(rows, key=lambda r: (r._node, r._d)):
            out.setdefault(r._node, []).append((r._d, r.n, r.l, r.h))
        return out

    def _text_bounds(self, node: _Node, digit: int) -> tuple[str, str] | None:
        """Bounds of the texts with this digit where they can be stated in whole characters: a single text."""
        low, high = node.low.encode(), node.high.encode()
        same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        value, length = divmod(digit, 3)
        if length == 2:
            return None
        text = (low[:same] + value.to_bytes(2, "big")[:length]).decode()  # the text ends here: it is whole
        return text, text

    def keys(self, ranks: list[int]) -> dict[int, tuple]:
        """The key at each rank (0-based, within the rows). Raises NotUnique where that key repeats across the cut."""
        wanted = sorted({r for r in ranks if 0 < r < self.n})
        out: dict[int, tuple] = {}
        if not wanted:
            return out
        self._first.ranks, self._first.count = wanted, self.n
        nodes, ready = [self._first], self._histogram
        while nodes:
            small = [n for n in nodes if n.count <= self._leaf] if ready is None else []
            if small:
                self._read(small, out)
            nodes = [n for n in nodes if n not in small]
            if not nodes:
                break
            descend = []
            for n in list(nodes):
                if n.null or (n.low is not None and n.low == n.high and not n.mixed):  # one value: on to the next column
                    nodes.remove(n)
                    if n.depth + 1 == len(self._cols):
                        if any(r > n.before for r in n.ranks):
                            raise NotUnique
                        out.update((r, (*n.fixed, None if n.null else n.low)) for r in n.ranks)
                    else:
                        descend.append(_Node([*n.fixed, None if n.null else n.low], n.count, n.before, n.ranks))
            loose = [n for n in nodes if n.low is None] + descend
            if loose:
                self._bound(loose)
                nodes += descend
                continue
            counted, ready = ready or self._count(nodes), None
            nodes = [x for i, n in enumerate(nodes) for x in self._refine(n, counted.get(i, []))]
        return out

    def _refine(self, node: _Node, buckets: list[tuple]) -> list[_Node]:
        out, before = [], node.before
        for digit, n, low, high in buckets:
            mine = [r for r in node.ranks if before <= r < before + n]
            if mine:
                x = _Node(node.fixed, n, before, mine, low, high, digit < 0)
                if isinstance(node.low, str) and digit >= 0:
                    x = self._text_node(node, digit, x)
                out.append(x)
            before += n
        return out

    def _text_node(self, node: _Node, digit: int, x: _Node) -> _Node:
        exact = self._text_bounds(node, digit)
        if exact:
            x.low, x.high = exact
        else:  # its smallest and largest text
            c = self._cols[node.depth]
            r = self._keys.where(_inside(node, self._cols) & (_digit(node, c) == digit)).agg(F.min(c), F.max(c)).first()
            x.low, x.high = r[0], r[1]
        return x

    def _read(self, nodes: list[_Node], out: dict[int, tuple]) -> None:
        """Keys at the ranks of small nodes, from their rows (at most LEAF each)."""
        found: dict[int, list[tuple]] = {}
        for r in self._tagged(nodes).collect():
            found.setdefault(r._node, []).append(tuple(r)[:-1])
        for i, n in enumerate(nodes):
            rows = sorted(found.get(i, []), key=lambda k: [(v is not None, v) for v in k])
            for r in n.ranks:
                at = r - n.before
                if at and rows[at] == rows[at - 1]:
                    raise NotUnique
                out[r] = rows[at]


def segments(df: DataFrame, order: list[Column | str], ranks: Callable[[int], list[int]], out: str,
             bounds: tuple[int, int] | None = None, leaf: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with the int column ``out``: how many of the ranks ``ranks(number of rows)`` are at most the row's 0-based
    position in ascending order of ``order`` (unique). Returns (rows, number of rows)."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    cols = digit_form(df, order)
    if cols is not None:
        chosen = Selection(df, cols, bounds, leaf)
        cuts = ranks(chosen.n)
        try:
            keys = chosen.keys(cuts)
            seg = F.lit(0)
            for r in cuts:
                if r <= 0:
                    seg = seg + 1
                elif r < chosen.n:
                    seg = seg + F.when(less(cols, keys[r]), 0).otherwise(1)
            return df.withColumn(out, seg.cast("int")), chosen.n
        except NotUnique:
            pass
    names = [f"_order{i}" for i in range(len(order))]
    idx, n = global_index(df.select("*", *[c.alias(x) for c, x in zip(order, names)]), names, "_i", with_count=True)
    seg = F.lit(0)
    for r in ranks(n):
        seg = seg + F.when(F.col("_i") >= r, 1).otherwise(0)
    return idx.withColumn(out, seg.cast("int")).select(*df.columns, out), n
