"""Packing of documents into fixed-length token sequences, first-fit decreasing.

Documents are dealt at random into groups of about ``group_docs`` documents; groups are
packed independently, in the task that encodes their texts, so only texts cross the
network, once.  The draw is seeded and goes by the row, not by its content, so copies of
one row are spread like any others; over stored tables it comes out the same when a task
is run again.  A group is closed early once it holds ``GROUP_CHARS`` characters, so very
long texts do not add up in a task; tasks follow the number of groups and get equally many.
In a group every document's ids
(with the end id) are cut into full sequences and a remainder; the remainders are
placed largest first, each in the first sequence with room, found by descending a
tournament tree of the sequences' free space.  Then sequences that still have room are
topped up with tokens cut from the last ones, and what is left of the last sequence is
split into lengths that are powers of two, which need no padding.

Defined cases: a null text counts as empty and is its end id alone; repeated rows are
packed each; a null id is carried through; very long texts give many full sequences;
an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_cache
from .tokens import ChunkEncoder, tokenizer_path

CAPACITY = 4096
END_ID = 2
GROUP_DOCS = 2048
GROUP_CHARS = 1 << 25
#: Groups of a task, about, up to the number of tasks a shuffle takes well.
TASK_GROUPS = 4
MAX_TASKS = 50_000
SEED = 9


class Tournament:
    """Free space of ``n`` bins; ``take(size)`` fills the first bin with room."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def take(self, size: int) -> int:
        best, at = self.best, 1
        if best[1] < size:
            raise ValueError("no bin has room")
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        best[at] -= size
        chosen = at - self.leaves
        while at > 1:
            at //= 2
            left, right = best[2 * at], best[2 * at + 1]
            best[at] = left if left > right else right
        return chosen


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length), for documents of ``lengths``."""
    full, rest = [], []
    for d, n in enumerate(lengths):
        whole = n - n % capacity
        full += [[(d, s, capacity)] for s in range(0, whole, capacity)]
        if n > whole:
            rest.append((n - whole, d, whole))
    rest.sort(key=lambda r: (-r[0], r[1]))
    tree = Tournament(len(rest), capacity)
    bins: list[list[tuple[int, int, int]]] = []
    for n, d, start in rest:
        b = tree.take(n)
        if b == len(bins):
            bins.append([])
        bins[b].append((d, start, n))
    return full + _top_up(bins, capacity)


def _top_up(bins, capacity):
    used = [sum(p[2] for p in b) for b in bins]
    i, j = 0, len(bins) - 1
    while i < j:
        room = capacity - used[i]
        if room == 0:
            i += 1
            continue
        d, start, n = bins[j].pop()
        cut = min(room, n)
        bins[i].append((d, start + n - cut, cut))
        used[i] += cut
        used[j] -= cut
        if cut < n:
            bins[j].append((d, start, n - cut))
        if not bins[j]:
            j -= 1
    if not bins:
        return bins
    last, out = bins[j], bins[:j]
    left = used[j]
    while left:
        size = 1 << (left.bit_length() - 1)
        seq, need = [], size
        while need:
            d, start, n = last.pop(0)
            cut = min(need, n)
            seq.append((d, start, cut))
            need -= cut
            if cut < n:
                last.insert(0, (d, start + cut, n - cut))
        out.append(seq)
        left -= size
    return out


def _packer(vocab, capacity: int, end_id: int, schema: pa.Schema, want_ids: bool, group_chars: int):
    end = end_id.to_bytes(4, "little")

    def one_group(group, first, ids, texts, encoder):
        """The pieces of a group, or of a part of it, with sequences numbered from ``first``."""
        codes = [c + end for c in encoder.encode_many(texts)]
        cols = {name: [] for name in schema.names}
        for k, seq in enumerate(pack([len(c) // 4 for c in codes], capacity), first):
            offset = 0
            for d, start, n in seq:
                raw = codes[d][4 * start:4 * (start + n)]
                for name, value in (("doc_id", ids[d]), ("start", start), ("length", n),
                                    ("ids_crc32", zlib.crc32(raw)), ("doc_tokens", len(codes[d]) // 4),
                                    ("sequence_id", group << 32 | k), ("offset", offset)):
                    cols[name].append(value)
                if want_ids:
                    cols["ids"].append(memoryview(raw).cast("I").tolist())
                offset += n
        return pa.RecordBatch.from_pydict(cols, schema=schema)

    def run(batches):
        encoder = worker_cache(("encoder", zlib.crc32(vocab.value.encode())), lambda: ChunkEncoder(vocab.value))
        group, first, ids, texts, chars = None, 0, [], [], 0
        for b in batches:
            for g, i, t in zip(*[b.column(k).to_pylist() for k in range(3)], strict=True):
                if ids and (g != group or chars >= group_chars):
                    out = one_group(group, first, ids, texts, encoder)
                    yield out
                    first = int(out.column("sequence_id")[-1].as_py() & 0xFFFFFFFF) + 1 if g == group else 0
                    ids, texts, chars = [], [], 0
                group = g
                ids.append(i)
                texts.append(t)
                chars += len(t or "")
        if ids:
            yield one_group(group, first, ids, texts, encoder)
    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, group_docs: int = GROUP_DOCS,
                   group_chars: int = GROUP_CHARS, vocabulary: str | None = None, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and with ``ids`` the token ids themselves."""
    from pyspark.sql.types import ArrayType, LongType, StructField, StructType

    with open(vocabulary or tokenizer_path(), encoding="utf-8") as f:
        vocab = docs.sparkSession.sparkContext.broadcast(f.read())
    groups = max(1, -(-docs.count() // group_docs))
    id_type = docs.schema[id_col].dataType
    fields = [StructField("doc_id", id_type)] + [
        StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    if ids:
        fields.append(StructField("ids", ArrayType(LongType())))
    schema = StructType(fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    tasks = max(min(groups, spark.sparkContext.defaultParallelism), min(-(-groups // TASK_GROUPS), MAX_TASKS))
    dealt = (docs.select(F.floor(F.rand(SEED) * groups).cast("long").alias("g"), F.col(id_col).alias("id"),
                         F.col(text_col).alias("t"))
             .repartitionById(tasks, (F.col("g") % tasks).cast("int"))
             .sortWithinPartitions("g", "id", F.octet_length("t")))
    return dealt.mapInArrow(_packer(vocab, capacity, end_id, to_arrow_schema(schema), ids, group_chars), schema)
