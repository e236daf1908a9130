"""How filters of documents interact: what each removes in every order, with duplicates found in radix tries.

Every text is inserted whole into a compressed trie whose terminals hold the smallest id of that
text. A worker first builds tries of its own rows, so that a text reaches the shuffle once for
each of them however often it is repeated. These texts are range partitioned by prefixes that
grow where many texts share them; a task then inserts one range into one trie and a traversal
tells every local text its smallest id. Only ids and masks meet the other columns again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casona.llm.files import partition
from casona.session import stored

FILTERS = "ABCDE"
#: Bits of the filters, in that order.
SHORT_, REPEATED, SHOUTING, MARKED, DUPLICATE = (1 << k for k in range(5))
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
#: Bytes of text of a worker's own trie.
LOCAL = 24 << 20
#: Bytes of prefix, from one level to the next.
LEVELS = tuple(8 * 4**k for k in range(8))
#: Bytes of text of a range; bytes that may share a prefix before it grows; prefixes of a level that may grow, and ranges, at most.
LEAF, GRAIN, MOST_LEAVES = 32 << 20, 64 << 10, 100_000

_not = lambda keep: bytes(x for x in range(256) if x not in keep)
_NO_CAPITALS, _NO_MARKS = _not(range(65, 91)), _not(b"#$%&*|")
_FOLLOWING = bytes(range(0x80, 0xC0))  # of a code point's bytes all but the first


def failing(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # by 0x20 and 0x09-0x0D
    points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, _FOLLOWING)))
    return (
        SHORT_ * (len(words) < LEAST_WORDS)
        | REPEATED * (100 * len(set(words)) < LEAST_DISTINCT * len(words))
        | SHOUTING * (100 * len(text.translate(None, _NO_CAPITALS)) > MOST_CAPITALS * points)
        | MARKED * bool(text.translate(None, _NO_MARKS)))


class Node:
    """An edge's bytes, the nodes below by first byte, and at a terminal the smallest id and the owners of its text."""

    __slots__ = ("label", "below", "least", "owners")

    def __init__(self, label: bytes, below: dict | None = None):
        self.label, self.below, self.least, self.owners = label, below or {}, None, None


def _shared(label: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and the rest of ``text``, which is shorter than the label."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        mid = (low + high + 1) >> 1
        if text.startswith(label[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """A compressed radix trie of whole texts."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, text: bytes, least: int | None) -> Node:
        """The terminal of ``text``, which keeps the smallest id that is not null."""
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = Node(text[at:])
                at = len(text)
            elif text.startswith(child.label, at):
                at += len(child.label)
            else:
                k = _shared(child.label, text, at)
                fork = Node(child.label[:k], {child.label[k]: child})
                child.label = child.label[k:]
                child = node.below[text[at]] = fork
                at += k
            node = child
        if node.owners is None:
            node.owners = []
        if least is not None and (node.least is None or least < node.least):
            node.least = least
        return node

    def terminals(self) -> Iterator[Node]:
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node.owners is not None:
                yield node
            waiting.extend(node.below.values())


STEPS = "array<struct<filter_order: string, step: int, bit: int, before: int>>"
ROWS = "doc_id bigint, part string, mask int, owner bigint, least bigint, size bigint, prefixes array<bigint>, text binary"


def _prefixes(text: bytes) -> list[int]:
    """Hashes of the prefix of each level, as far as the text goes."""
    out = []
    for n in LEVELS:
        out.append(int.from_bytes(hashlib.blake2b(text[:n], digest_size=8).digest(), "little", signed=True))
        if n >= len(text):
            break
    return out


def _read(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """Every row with its mask of A to D and its owner, a text of a local trie; the owner's first row has the text and its smallest id there."""

    def emptied(trie: Trie, rows: list, number: int) -> pa.RecordBatch:
        columns: dict[str, list] = {name: [] for name in ROWS.replace(",", "").split()[::2]}
        mine: dict[int, int] = {}
        for doc_id, part, mask, text, terminal in rows:
            first = id(terminal) not in mine
            owner = mine.setdefault(id(terminal), number + len(mine))
            more = (terminal.least, len(text), _prefixes(text), text) if first else (None,) * 4
            for column, value in zip(columns.values(), (doc_id, part, mask, owner, *more)):
                column.append(value)
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns.values(), kinds)], list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, rows, size, number = Trie(), [], 0, partition() << 36
        for batch in batches:
            for doc_id, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py() or b""
                terminal = trie.insert(text, doc_id)
                rows.append((doc_id, part, failing(text) if not terminal.owners else terminal.owners[0], text if not terminal.owners else b"", terminal))
                if not terminal.owners:
                    terminal.owners.append(rows[-1][2])
                    size += len(text)
                size += 64
                if size >= LOCAL:
                    yield emptied(trie, rows, number)
                    number += len(rows)
                    trie, rows, size = Trie(), [], 0
        if rows:
            yield emptied(trie, rows, number)

    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("binary").alias("text"))
    return chosen.mapInArrow(run, ROWS)


def _deep(texts: DataFrame, leaf: int, grain: int, most: int) -> tuple[set[int], int]:
    """Hashes of the prefixes that more than a grain's bytes share, and the number of ranges.

    The grain grows with the corpus, so at most ``most`` prefixes of a level come to the driver.
    """
    total = texts.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    grain = max(grain, total // most + 1)
    shares = texts.select("size", F.posexplode("prefixes").alias("level", "hash")).groupBy("level", "hash").agg(F.sum("size").alias("size"))
    return {r[0] for r in shares.filter(F.col("size") > grain).select("hash").collect()}, max(1, min(most, -(-total // leaf)))


def _smallest(texts: DataFrame, leaf: int, grain: int, most: int) -> DataFrame:
    """(owner, first): the smallest id of each owner's text in the whole table."""
    deep, leaves = _deep(texts, leaf, grain, most)

    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(3)
            prefix = []
            for hashes, t in zip(batch.column(2).to_pylist(), text):
                level = next((k for k, h in enumerate(hashes) if h not in deep), len(hashes) - 1)
                prefix.append(t.as_py()[:LEVELS[level]])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prefix, pa.binary()), text], ["owner", "least", "prefix", "text"])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            for owner, least, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                trie.insert(text.as_py(), least).owners.append(owner)
        owners, firsts = [], []
        for node in trie.terminals():
            owners += node.owners
            firsts += [node.least] * len(node.owners)
        yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(firsts, pa.int64())], ["owner", "first"])

    dealt = texts.select("owner", "least", "prefixes", "text").mapInArrow(prefixed, "owner bigint, least bigint, prefix binary, text binary")
    return dealt.repartitionByRange(leaves, "prefix").select("owner", "least", "text").mapInArrow(reduced, "owner bigint, first bigint")


def failures(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", leaf: int = LEAF,
    grain: int = GRAIN, most: int = MOST_LEAVES,
) -> DataFrame:
    """(doc_id, part, mask) of every row: the filters that it fails, A to E as bits 1 to 16.

    A null text is empty, a null part is ''. E: some smaller id has the identical text; rows
    without an id never fail it nor make others fail, and rows that share an id are no smaller
    than each other. Other columns are not read; an empty table gives no rows.
    """
    rows = stored(_read(docs, id_col, text_col, part_col), "filter-rows")
    first = _smallest(rows.filter(F.col("text").isNotNull()), leaf, grain, most)
    return rows.select("doc_id", "part", "mask", "owner").join(first, "owner").select(
        "doc_id", "part", (F.col("mask") + F.when(F.col("doc_id") > F.col("first"), DUPLICATE).otherwise(0)).alias("mask"))


def audit(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """What every filter does at every step of every order, one row for each part, order and step.

    Of labels that repeat an id, any with quality 1 makes it good and any with toxic 1 toxic. Rows
    are counted by part, mask and labels first; the orders are spread out of these few counts.
    """
    any_of = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("l_id")).agg(any_of("quality"), any_of("toxic"))
    counted = failed.join(marks, F.col("doc_id") == F.col("l_id"), "left").groupBy("part", "mask").agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            steps.append({"filter_order": "".join(FILTERS[x] for x in order), "step": step, "bit": 1 << k, "before": before})
            before |= 1 << k
    spread = counted.withColumn("s", F.explode(F.from_json(F.lit(json.dumps(steps)), STEPS))).select("part", "mask", "rows", "good", "toxic", "s.*")
    earlier, fails = F.col("mask").bitwiseAND(F.col("before")) != 0, F.col("mask").bitwiseAND(F.col("bit")) != 0
    sums = lambda of, when: F.sum(F.when(when, F.col(of)).otherwise(0))
    each = spread.groupBy("part", "filter_order", "step", "bit").agg(
        sums("rows", ~earlier & ~fails).alias("kept"), sums("rows", ~earlier & fails).alias("removed"), sums("rows", earlier & fails).alias("redundant"),
        sums("rows", F.col("mask") == F.col("bit")).alias("unique_fails"), sums("good", ~earlier & fails).alias("good_lost"),
        sums("toxic", ~earlier & fails).alias("toxic_lost"))
    return each.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")
