"""Edit-aware token counts.

Each document keeps a segment tree over runs of its pre-tokens: a leaf is a
run of some ``LEAF`` characters cut at white space, where no token spans; the
nodes hold sums of characters and tokens.  An edit finds its leaves by
descending the character sums, re-encodes the touched leaves only (and a
neighbour, where the edit took away the white space between them) and updates
the sums above.

Edits are (start, end, text): characters start to end - 1 are replaced by
text, in the text as the edits before left it.

Texts are counted and edited where they are, without a shuffle; a table of
edits is first gathered into an array by document.

Defined cases: a null text is an empty one; null edits are none; a null start
or end is 0, a null replacement empty; offsets are clipped to the text and an
end before the start is the start; repeated rows are edited alike; an empty
table gives no rows; the columns added replace columns of the same name.
"""
from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runoff.llm.tokens import word_encoder

LEAF = 256
SPACE = " \t\n\r\x0b\x0c"
_GAP = re.compile(r"[ \t\n\r\x0b\x0c]")


class Sums:
    """A segment tree of whole numbers, as a heap: node i sums 2 i and 2 i + 1."""

    def __init__(self, leaves: list[int]):
        self.first = 1
        while self.first < len(leaves):
            self.first *= 2
        self.heap = [0] * self.first + leaves + [0] * (self.first - len(leaves))
        for i in range(self.first - 1, 0, -1):
            self.heap[i] = self.heap[2 * i] + self.heap[2 * i + 1]

    @classmethod
    def kept(cls, heap: list[int]) -> "Sums":
        self = cls.__new__(cls)
        self.heap, self.first = list(heap), len(heap) // 2
        return self

    def total(self) -> int:
        return self.heap[1]

    def put(self, leaf: int, value: int) -> None:
        i = self.first + leaf
        change = value - self.heap[i]
        while i and change:
            self.heap[i] += change
            i //= 2

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds unit ``position`` (less than the total), and the position in it."""
        i = 1
        while i < self.first:
            i *= 2
            if position >= self.heap[i]:
                position -= self.heap[i]
                i += 1
        return i - self.first, position


def cut(text: str) -> list[str]:
    """Runs of at least ``LEAF`` characters (but the last), each ending in white space."""
    out, at = [], 0
    while len(text) - at > LEAF:
        gap = _GAP.search(text, at + LEAF)
        if not gap:
            break
        out.append(text[at:gap.end()])
        at = gap.end()
    return [*out, text[at:]]


class CountedText:
    """A text with its tree.  ``count`` gives the tokens of a run of text."""

    def __init__(self, text: str, count, tree: tuple[list[int], list[int]] | None = None):
        self.count, self.reencoded = count, 0
        if tree is None:
            self.leaves = cut(text)
            self.chars = Sums([len(x) for x in self.leaves])
            self.tokens = Sums([count(x) for x in self.leaves])
        else:
            self.chars, self.tokens = Sums.kept(tree[0]), Sums.kept(tree[1])
            self.leaves, at = [], 0
            for n in self.chars.heap[self.chars.first:]:
                self.leaves.append(text[at:at + n])
                at += n

    def _put(self, leaf: int, text: str) -> None:
        self.leaves[leaf] = text
        self.chars.put(leaf, len(text))

    def edit(self, start: int, end: int, new: str) -> None:
        total = self.chars.total()
        start = min(max(start, 0), total)
        end = min(max(end, start), total)
        first, a = self.chars.find(start) if start < total else self._end()
        last, b = self.chars.find(end) if end < total else self._end()
        region = self.leaves[first][:a] + new + self.leaves[last][b:]
        for leaf in range(first, last + 1):
            self._put(leaf, "")
            self.tokens.put(leaf, 0)
        begin = start - a  # where the region begins in the text
        # without white space at its border the region takes in its neighbour
        while True:
            before = self.chars.find(begin - 1)[0] if begin else None
            after = self.chars.find(begin)[0] if begin < self.chars.total() else None
            left = self.leaves[before] if before is not None else ""
            right = self.leaves[after] if after is not None else ""
            if right and (region[-1] not in SPACE and right[0] not in SPACE if region else True):
                region += right
                taken = after
            elif left and region and left[-1] not in SPACE and region[0] not in SPACE:
                region = left + region
                taken = before
                begin -= len(left)
                if before < first:
                    first = before
            else:
                break
            self._put(taken, "")
            self.tokens.put(taken, 0)
        self._put(first, region)
        self.tokens.put(first, self.count(region))
        self.reencoded += len(region)

    def _end(self) -> tuple[int, int]:
        if not self.chars.total():
            return 0, 0
        leaf, at = self.chars.find(self.chars.total() - 1)
        return leaf, at + 1

    def text(self) -> str:
        return "".join(self.leaves)


_TREE = pa.struct([("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))])
_TREE_SQL = "struct<chars: array<int>, tokens: array<int>>"
#: Texts handled at once.
ROWS = 256


def _counter(spec):
    enc = word_encoder(spec.value)
    return lambda text: len(enc.encode(text.encode())) // 4


def _added(df: DataFrame, spec, added: dict[str, tuple[str, pa.DataType]], row, drop=()) -> DataFrame:
    """``df`` with the columns that ``row`` (count, row as dict) gives; ``drop``: columns it replaces or takes."""
    kept = [c for c in df.columns if c not in added and c not in drop]
    used = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)],
                     F.struct(*[F.col(c) for c in ("text", "tree", "edits") if c in df.columns]).alias("_row"))

    def run(batches):
        count = _counter(spec)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                found = [row(count, r) for r in b.column("_row").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-1], *[pa.array([f[i] for f in found], t) for i, (_, t) in enumerate(added.values())]],
                    names=[*b.schema.names[:-1], *added])

    kind = ", ".join([f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
                     + [f"{c} {t}" for c, (t, _) in added.items()])
    out = used.mapInArrow(run, kind)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], *added)


def _spec(df: DataFrame, tokenizer: str):
    with open(tokenizer, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def with_trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` (with text) with tree (its nodes' sums) and n_tokens."""
    def row(count, r):
        t = CountedText(r["text"] or "", count)
        return {"chars": t.chars.heap, "tokens": t.tokens.heap}, t.tokens.total()

    out = _added(docs, _spec(docs, tokenizer),
                 {"tree": (_TREE_SQL, _TREE), "n_tokens": ("long", pa.int64())}, row)
    return out


def edited(docs: DataFrame, tokenizer: str, with_text: bool = True) -> DataFrame:
    """Rows with text, tree and edits (array of start, end, text) after their
    edits: n_tokens, n_chars, n_reencoded (characters encoded for the edits)
    and, ``with_text``, the new text and tree.  Edits are used up."""
    def row(count, r):
        tree = r.get("tree")
        t = CountedText(r["text"] or "", count, tree and (tree["chars"], tree["tokens"]))
        for e in r.get("edits") or []:
            if e is not None:
                t.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
        numbers = t.tokens.total(), t.chars.total(), t.reencoded
        return (*numbers, t.text(), {"chars": t.chars.heap, "tokens": t.tokens.heap}) if with_text else numbers

    added = {c: ("long", pa.int64()) for c in ("n_tokens", "n_chars", "n_reencoded")}
    if with_text:
        added |= {"text": ("string", pa.string()), "tree": (_TREE_SQL, _TREE)}
    return _added(docs, _spec(docs, tokenizer), added, row, drop=("text", "tree", "edits"))
