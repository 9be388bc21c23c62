"""Edit-aware token counts.

A document's text is kept as a segment tree over runs of pre-tokens. A run ends only where the pre-tokeniser must
start a new pre-token whatever stands around: at a single space between two characters that are not white space, and
between a letter or digit and a line end or punctuation, so that Chinese, Japanese and code without spaces are cut too.
Tokens of the whole are therefore the sum over runs. Leaves hold (characters, tokens), inner nodes their sums.

``trees`` encodes documents once; its table is kept. ``edited`` applies edits to kept trees and gives them back.
An edit replaces characters [a, b) by new text. Only the runs it touches, and one run on either side as
boundary context, are cut and encoded anew; the leaves of the others are reused. Above as many leaves as before only the
sums on the path change; where the number of leaves changes, the sums to the right of the edit are added up again.

Edge cases: null and empty texts have 0 tokens and a tree without leaves; a text without a safe boundary (one word,
however long) is one run; very long texts are one tree; repeated rows get equal counts; an empty table gives no rows;
other columns are ignored. An edit beyond the end of a text appends to it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from fathomline.llm.common import dicts, small_batches, staged, text_or_empty
from fathomline.llm.tokens import encoder

#: Characters after which a run ends at the next safe boundary.
RUN_CHARS = 512
FANOUT = 16
#: Letters and digits are named one by one, as Unicode tables of different libraries may differ.
SAFE = re.compile(r"(?<=\S) (?=\S)|(?<=[A-Za-z0-9\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5])(?=[\n!-&(-/:-@\[-`{-~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])")


def cut(text: str, run_chars: int = RUN_CHARS) -> list[str]:
    """The runs of a text; the spaces that start them belong to them."""
    out, at, n = [], 0, len(text)
    while n - at > run_chars:
        m = SAFE.search(text, at + run_chars)
        if not m:
            break
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]] if at < n else out


class SegmentTree:
    """levels[0]: leaves (characters, tokens); levels[k + 1]: sums over FANOUT entries of levels[k]."""

    def __init__(self, text: str, count: Callable[[str], int], run_chars: int = RUN_CHARS, leaves: list[tuple[int, int]] | None = None) -> None:
        self.text, self.count, self.run_chars = text, count, run_chars
        self.encoded_chars = 0
        self.levels = [leaves if leaves is not None else [self._leaf(r) for r in cut(text, run_chars)]]
        self._sums(0)

    def _leaf(self, run: str) -> tuple[int, int]:
        self.encoded_chars += len(run)
        return len(run), self.count(run)

    def _sums(self, first: int, last: int | None = None) -> None:
        """Bring the sums above leaves ``first`` up to, not with, ``last`` (the end) up to date."""
        k = 0
        while len(self.levels[k]) > 1:
            below, first = self.levels[k], first // FANOUT
            last = None if last is None else -(-last // FANOUT)
            if k + 1 == len(self.levels):
                self.levels.append([])
                first, last = 0, None
            blocks = range(first * FANOUT, len(below) if last is None else last * FANOUT, FANOUT)
            self.levels[k + 1][first:last] = [(sum(x for x, _ in block), sum(y for _, y in block)) for block in (below[i : i + FANOUT] for i in blocks)]
            k += 1
        del self.levels[k + 1 :]

    @property
    def tokens(self) -> int:
        return self.levels[-1][0][1] if self.levels[0] else 0

    def leaf_at(self, char: int) -> tuple[int, int]:
        """(index, first character) of the leaf that holds ``char``, found from the root down."""
        i, start = 0, 0
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            last = min(len(level), i + FANOUT) - 1 if k < len(self.levels) - 1 else len(level) - 1
            while i < last and start + level[i][0] <= char:
                start += level[i][0]
                i += 1
            i = i * FANOUT if k else i
        return i, start

    def edit(self, a: int, b: int, new: str) -> None:
        """Replace characters [a, b) by ``new``."""
        old, leaves = self.text, self.levels[0]
        self.text = text = old[:a] + new + old[b:]
        if not leaves:
            self.levels[0] = [self._leaf(r) for r in cut(text, self.run_chars)]
            self._sums(0)
            return
        i, start = self.leaf_at(max(0, a - 1))
        if i:  # one more run as context: the boundary before it stays safe, as it lies a run away from the edit
            i -= 1
            start -= leaves[i][0]
        j, at = self.leaf_at(min(len(old) - 1, b))
        end = at + leaves[j][0]
        j += 1
        if j < len(leaves):
            end += leaves[j][0]
            j += 1
        # The boundary at ``end`` is safe only for the characters around it, which the edit leaves alone.
        part = text[start : end + len(text) - len(old)]
        made = [self._leaf(r) for r in cut(part, self.run_chars)]
        leaves[i:j] = made
        self._sums(i, j if len(made) == j - i else None)


TREE = "doc_id long, text string, chars array<int>, tokens array<int>"
_TREE = [("doc_id", pa.int64()), ("text", pa.string()), ("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))]
COUNTS = "n_tokens long, n_runs long, edited_tokens long, encoded_chars long, reencoded_chars long"
_COUNTS = [(c.split()[0], pa.int64()) for c in COUNTS.split(", ")]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def trees(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, chars, tokens): the text and its tree's leaves, as a table in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder().count
        for x in dicts(batches):
            rows = []
            for doc, text in zip(x["doc_id"], x["text"], strict=True):
                runs = cut(text)
                rows.append((doc, text, [len(r) for r in runs], [count(r) for r in runs]))
            yield _batch(rows, _TREE)

    small_batches(docs.sparkSession)
    return staged(docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, TREE), "token-trees")


def edited(rows: DataFrame, keep: bool = True) -> DataFrame:
    """Of kept trees with an edit each (a, b, new): tokens and runs before, tokens after, characters encoded for either, and,
    if ``keep``, the edited trees in the form of ``trees``. Only what the edit touches is encoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder().count
        for x in dicts(batches):
            out = []
            for doc, text, chars, tokens, a, b, new in zip(*(x[c] for c in ("doc_id", "text", "chars", "tokens", "a", "b", "new")), strict=True):
                tree = SegmentTree(text, count, leaves=list(zip(chars, tokens, strict=True)))
                before, runs = tree.tokens, len(chars)
                tree.edit(a, b, new)
                after = (tree.text, [n for n, _ in tree.levels[0]], [n for _, n in tree.levels[0]]) if keep else ()
                out.append((doc, *after, before, runs, tree.tokens, sum(chars), tree.encoded_chars))
            yield _batch(out, (_TREE if keep else _TREE[:1]) + _COUNTS)

    small_batches(rows.sparkSession)
    schema = f"{TREE if keep else 'doc_id long'}, {COUNTS}"
    return rows.select("doc_id", "text", "chars", "tokens", "a", "b", "new").mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    """Each whole text, and the text with its middle character range [n/2, n/2 + 16) replaced by its own first 24 characters:
    the trees are kept first, then edited."""
    edits = trees(docs).selectExpr("*", "length(text) div 2 as a", "least(length(text) div 2 + 16, length(text)) as b", "left(text, 24) as new")
    return edited(edits, keep=False)
