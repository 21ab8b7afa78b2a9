"""Multi-line CSV read in many tasks (SRC-3, SRC-4).

Whether a line break ends a record depends on all quotes before it.  A first pass over the file's splits finds, for
each, in which state (between records, or inside a quoted field) its end is for either state of its start, and how many
records start in it; folding these few numbers in file order gives every split's state and first row number.  A second
pass then cuts each split into records on its own.  Only a record that crosses a split's border is put together by a
shuffle.  ``from_csv`` parses the records, so values are those of Spark's own reader.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

OUT, IN = 0, 1
_STATES = "file string, block long, end_out int, end_in int, records_out long, records_in long"
_PIECES = "file string, row long, block long, whole boolean, text string"


def _lines(spark: SparkSession, path) -> DataFrame:
    """Physical lines (up to a line feed) with the split they are in; Spark cuts the files."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def line_ends(lines: pa.Array, sep: str = ",") -> tuple[np.ndarray, np.ndarray]:
    """(state after each line that starts between records, state after it if it starts inside a quoted field)."""
    import pyarrow.compute as pc

    def open_at_end(text: pa.Array) -> np.ndarray:
        # RE2: without the fields that are quoted as a whole, is there another opening quote?
        rest = pc.replace_substring_regex(text, pattern=rf'(^|[{sep}])"([^"]|"")*"', replacement=r"\1")
        return np.asarray(pc.match_substring_regex(rest, rf'(^|[{sep}])"')).astype(np.int8)

    return open_at_end(lines), open_at_end(pc.binary_join_element_wise(pa.scalar('"'), lines, pa.scalar("")))


class _Walk:
    """States along the lines of one split, batch after batch, from one state at its start."""

    def __init__(self, state: int):
        self.state = state

    def before(self, n: int, quoted: np.ndarray, ends: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """State before each of ``n`` lines; ``quoted`` lists the lines with quotes, ``ends`` their :func:`line_ends`."""
        after, state = np.empty(len(quoted) + 1, np.int8), self.state
        after[0] = state
        for i, (out, inside) in enumerate(zip(ends[OUT].tolist(), ends[IN].tolist()), 1):
            state = inside if state else out
            after[i] = state
        self.state = int(state)
        return after[np.searchsorted(quoted, np.arange(n), side="left")]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array, np.ndarray]]:
    """Lines of a batch by split, in order, and which of them hold a quote."""
    import pyarrow.compute as pc

    block, file = np.asarray(batch["block"]), batch["file"].to_pylist()
    cuts = [i for i in range(1, batch.num_rows) if block[i] != block[i - 1] or file[i] != file[i - 1]]
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            lines = batch["value"].slice(a, b - a)
            yield (file[a], int(block[a])), lines, np.flatnonzero(np.asarray(pc.match_substring(lines, '"')))


def _blank(lines: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.or_(pc.equal(lines, ""), pc.equal(lines, "\r")))


def _states(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, walks, records, rows = None, [], [0, 0], []
        for batch in batches:
            for here, lines, quoted in _parts(batch):
                if here != key:
                    if key is not None:
                        rows.append((*key, *(w.state for w in walks), *records))
                    key, walks, records = here, [_Walk(OUT), _Walk(IN)], [0, 0]
                ends, text = line_ends(lines.take(pa.array(quoted)), sep), ~_blank(lines)
                for s in (OUT, IN):
                    records[s] += int(((walks[s].before(len(lines), quoted, ends) == OUT) & text).sum())
        if key is not None:
            rows.append((*key, *(w.state for w in walks), *records))
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                         names=["file", "block", "end_out", "end_in", "records_out", "records_in"])

    return run


def _records(starts: dict[tuple[str, int], tuple[int, int]], sep: str):
    """Cut every split into records: whole ones, and the pieces of those that cross its borders."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        key, walk, row, held, begun = None, None, 0, [], False

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                              names=["file", "row", "block", "whole", "text"])

        for batch in batches:
            out: list[tuple] = []
            for here, lines, quoted in _parts(batch):
                if here != key:
                    if held:                       # the split's last record goes on in the next one, if it is open
                        out.append((key[0], row, key[1], begun and walk.state == OUT, "\n".join(held)))
                    key, held = here, []
                    state, row = starts[here]
                    walk, begun = _Walk(state), False
                before = walk.before(len(lines), quoted, line_ends(lines.take(pa.array(quoted)), sep))
                opens = np.flatnonzero((before == OUT) & ~_blank(lines))
                if not len(opens):
                    held += [v for v, s in zip(lines.to_pylist(), before) if s == IN]
                    continue
                held += [v for v, s in zip(lines.slice(0, opens[0]).to_pylist(), before) if s == IN]
                if held:
                    out.append((key[0], row, key[1], begun, "\n".join(held)))
                # records of this batch: a line that opens one and the lines inside it; blank lines between records go
                inner = np.flatnonzero((before == IN) & (np.arange(len(lines)) > opens[0]))
                chosen = np.sort(np.concatenate([opens, inner]))
                at = np.append(np.searchsorted(chosen, opens), len(chosen)).astype(np.int32)
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(at), lines.take(pa.array(chosen))), "\n").to_pylist()
                out += [(key[0], row + 1 + i, key[1], True, t) for i, t in enumerate(joined[:-1])]
                row, held, begun = row + len(joined), [joined[-1]], True
            if out:
                yield batch_of(out)
        if held:
            yield batch_of([(key[0], row, key[1], begun and walk.state == OUT, "\n".join(held))])

    return run


def read_split_csv(spark: SparkSession, path, schema: StructType, sep: str = ",", header: bool = True,
                   with_row_id: str | None = "row_id") -> DataFrame:
    """The records of one or many CSV files with quoted, multi-line fields (a quote inside a field is doubled), in
    the columns of ``schema``; ``with_row_id`` is a dense number from 0 in order of file name and place.

    Files are read in Spark's splits, each line twice.  The driver folds one row per split (a split is
    ``spark.sql.files.maxPartitionBytes`` of file).  Blank lines are no records; short records end in nulls; line
    ends inside a field stay as they are.
    """
    lines = _lines(spark, path)
    found = lines.mapInArrow(_states(sep), _STATES).collect()
    starts: dict[tuple[str, int], tuple[int, int]] = {}
    base, offsets = 0, {}
    for file in sorted({r["file"] for r in found}):
        state, row = OUT, -2 if header else -1          # number of the record that is open or last before the split
        offsets[file] = base
        for r in sorted((r for r in found if r["file"] == file), key=lambda r: r["block"]):
            starts[file, r["block"]] = state, row
            row += r["records_in"] if state else r["records_out"]
            state = r["end_in"] if state else r["end_out"]
        base += max(row + 1, 0)
    pieces = lines.mapInArrow(_records(starts, sep), _PIECES)
    crossing = (pieces.where("not whole").groupBy("file", "row").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "\n").alias("text")))
    every = pieces.where("whole").select("file", "row", "text").unionByName(crossing).where("row >= 0")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    parsed = every.select("file", "row", F.from_csv(F.regexp_replace("text", r"\r\z", ""), ddl, options).alias("r"))
    out = [F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields]
    if with_row_id:
        table = spark.createDataFrame(list(offsets.items()) or [("", 0)], "file string, base long")    # a row per file
        parsed = parsed.join(F.broadcast(table) if len(offsets) <= 100_000 else table, "file")
        out.append((F.col("base") + F.col("row")).alias(with_row_id))
    return parsed.select(*out)
