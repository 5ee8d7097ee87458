"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased and their whitespace runs become one space. An item of m characters occurs in a document if some stretch
of the document is within e = floor(``ERRORS`` * m) insertions, deletions and substitutions of the whole item. Cut into e + 1
pieces, the item then has a piece without any error: all pieces are sought exactly (Aho-Corasick), and around each hit the
item is verified with Myers' bit-parallel distance. Every item and every whole document is compared.

The items are stored in the shared folder in blocks of about ``BLOCK_BYTES``, which tasks open one after the other for each
``TEXT_BYTES`` of their texts; no item passes through the driver, and neither it nor the plan grows with the benchmark. Documents are
read in one stage without a shuffle. Null or blank items occur nowhere; repeated items count once per row, rows without id as null (the last in
the list). Null texts hold no item; texts of any length are compared whole. Extra columns pass through; columns named like the added ones are
replaced. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F, types as T

from roadflux import workspace
from roadflux.llm.warc import filesystem

ERRORS = 0.08
BLOCK_BYTES = 1 << 20
TEXT_BYTES = 32 << 20
ROWS_PER_BATCH = 500


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): errors + 1 pieces whose lengths differ by one at most."""
    parts = min(errors + 1, len(item))
    cuts = [len(item) * k // parts for k in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' bit-parallel matching of a whole item against stretches of a text."""

    def __init__(self, item: str):
        self.size = len(item)
        self.errors = int(ERRORS * self.size)
        self.at: dict[str, int] = {}
        for k, c in enumerate(item):
            self.at[c] = self.at.get(c, 0) | 1 << k

    def occurs(self, text: str) -> bool:
        if not self.errors:
            raise AssertionError("an exact piece is the whole item")
        full, last = (1 << self.size) - 1, 1 << self.size - 1
        plus, minus, distance, at = full, 0, self.size, self.at
        for c in text:
            eq = at.get(c, 0)
            x = eq | minus
            d = (((x & plus) + plus) ^ plus) | x
            up = minus | (full & ~(d | plus))
            down = plus & d
            if up & last:
                distance += 1
            elif down & last:
                distance -= 1
            if distance <= self.errors:
                return True
            up = up << 1 & full  # a stretch may begin anywhere
            plus = (down << 1 & full) | (full & ~((eq | minus) | up) & full)
            minus = (eq | minus) & up
            plus = plus & full
        return False


class Matcher:
    def __init__(self, items: list[tuple[int | None, str]]):
        self.items = [(i, Pattern(t)) for i, t in items]
        self.finder = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text) in enumerate(items):
            for offset, piece in pieces(text, self.items[n][1].errors):
                places.setdefault(piece, []).append((n, offset))
        for piece, own in places.items():
            self.finder.add_word(piece, (len(piece), own))
        if places:
            self.finder.make_automaton()
        self.any = bool(places)

    def found(self, text: str | None) -> list[int | None]:
        """Ids of the items that occur in the text."""
        whole = plain(text)
        hits: set[int] = set()
        if not (whole and self.any):
            return []
        tried: dict[int, tuple[int, int]] = {}
        for end, (length, own) in self.finder.iter(whole):
            for n, offset in own:
                if n in hits:
                    continue
                pattern = self.items[n][1]
                if not pattern.errors:
                    hits.add(n)
                    continue
                begin = end + 1 - length - offset - pattern.errors
                until = begin + pattern.size + 2 * pattern.errors
                a, b = tried.get(n, (0, -1))
                if a <= begin and until <= b:
                    continue
                if pattern.occurs(whole[max(0, begin):until]):
                    hits.add(n)
                else:
                    tried[n] = (begin, until)
        return [self.items[n][0] for n in sorted(hits)]


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """All columns, plus leaked (ids of the items that occur, ascending)."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    docs = docs.drop("leaked") if "leaked" in docs.columns else docs
    folder, blocks = stored(benchmark, item_id, item_text)
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    at = names.index(text_col)
    schema = T.StructType([*[T.StructField(c, f.dataType) for c, f in zip(inner, docs.schema.fields)], T.StructField("leaked", T.ArrayType(T.LongType()))])
    out = docs.toDF(*inner).mapInArrow(_search(folder, blocks, at), schema)
    return out.withColumn("leaked", F.array_sort("leaked")).toDF(*names, "leaked")


def stored(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text") -> tuple[str, int]:
    """Write the items in blocks below a folder; the folder and the number of blocks."""
    spark = benchmark.sparkSession

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([plain(t.as_py()) for t in batch.column(1)], pa.string())], ["id", "item"])

    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("t"))
    items = workspace.written(items.mapInArrow(normal, "id long, item string").where("item <> ''"), "items")
    total = items.agg(F.sum(F.octet_length("item"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    folder = workspace.fresh_path(spark, "item-blocks")
    if blocks:
        # the row's own number keeps repeated items apart
        place = F.pmod(F.xxhash64("item", "id", F.monotonically_increasing_id()), F.lit(blocks))
        items.withColumn("block", place).repartition("block").write.partitionBy("block").parquet(folder)
    return folder, blocks


def _block(folder: str, number: int) -> Matcher:
    files, root = filesystem(f"{folder}/block={number}")
    if files.get_file_info(root).type == pyarrow.fs.FileType.NotFound:
        return Matcher([])  # no item fell into it
    found = pyarrow.dataset.dataset(root, format="parquet", filesystem=files).to_table(columns=["id", "item"])
    return Matcher(sorted(zip(found.column(0).to_pylist(), found.column(1).to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def _search(folder: str, blocks: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: list = [None, None]  # number and matcher of the last block
        forward = True
        for held in _gathered(batches, at):
            found = [[[] for _ in range(batch.num_rows)] for batch in held]
            # back and forth: the last block of one turn is the first of the next
            for number in range(blocks) if forward else range(blocks - 1, -1, -1):
                if opened[0] != number:
                    opened[1] = None  # before the next one is built
                    opened[:] = number, _block(folder, number)
                for batch, own in zip(held, found):
                    for leaked, text in zip(own, batch.column(at)):
                        leaked += opened[1].found(text.as_py())
            forward = not forward
            for batch, own in zip(held, found):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.list_(pa.int64()))], [*batch.schema.names, "leaked"])

    return run


def _gathered(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches whose texts have ``TEXT_BYTES`` or more together."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(at).nbytes
        if size >= TEXT_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held
