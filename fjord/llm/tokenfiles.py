"""Token ids as flat binary files with 64-bit document offsets.

Documents are range-partitioned by id, so partition k holds smaller ids than
partition k + 1; there are at least as many partitions as keep the texts of a
file within ``FILE_BYTES``. Each task encodes its documents in order and appends
to

* ``part-k.bin``  ids of all documents, little-endian unsigned integers (16 bits
  where the vocabulary allows, else 32), nothing between them
* ``part-k.idx``  one unsigned 64-bit offset per document and one for the end,
  counted in ids from the start of the file
* ``part-k.doc``  one signed 64-bit document id each, and ``part-k.nul``, one
  byte each: 1 for a null id

under a name of its own attempt and renames it when complete, so a task that is
tried again, or twice at once, leaves one good file. What a task reports is its
counts: prefix sums over partitions give each file's base, and a document's
global start is base + offset. :func:`read_back` maps the files into memory; where a
folder is no local path and cannot be mapped, it reads ranges by offset.

Only one document at a time is held besides Arrow's batch. Files are written
with plain file calls where the folder is a ``file:`` URI or a path, and with
pyarrow's file systems elsewhere.

Defined cases: a null text counts as empty and yields the end id alone; null
ids come first; documents that share an id are ordered by their place in the
input; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fjord.llm.common import ship, stage
from fjord.llm.tokens import encoder

PIECE = 1 << 20  # ids turned into 32 bits at once
FILE_BYTES = 1 << 29


class Ranges:
    """Ids of a file that cannot be mapped: a slice is read when it is asked for."""

    def __init__(self, file, dtype: str):
        self.file, self.dtype = file, np.dtype(dtype)

    def __len__(self) -> int:
        return self.file.size() // self.dtype.itemsize

    def __getitem__(self, part: slice) -> np.ndarray:
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((part.stop - part.start) * width, part.start * width), self.dtype)


class Folder:
    """Writing, renaming and reading files of a shared folder, given as a path or a URI."""

    def __init__(self, uri: str):
        self.local = uri.startswith("file:") or "://" not in uri
        if self.local:
            self.fs, self.path = None, uri.removeprefix("file://").removeprefix("file:")
            os.makedirs(self.path, exist_ok=True)
        else:
            self.fs, self.path = arrow_fs.FileSystem.from_uri(uri)
            self.fs.create_dir(self.path)

    def open(self, name: str):
        full = f"{self.path}/{name}"
        return open(full, "wb") if self.local else self.fs.open_output_stream(full)

    def rename(self, old: str, new: str) -> None:
        old, new = f"{self.path}/{old}", f"{self.path}/{new}"
        os.replace(old, new) if self.local else self.fs.move(old, new)

    def read(self, name: str, dtype: str) -> np.ndarray | Ranges:
        full = f"{self.path}/{name}"
        if not self.local:
            return Ranges(self.fs.open_input_file(full), dtype)
        return np.memmap(full, dtype, "r") if os.path.getsize(full) else np.zeros(0, dtype)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          partitions: int | None = None) -> DataFrame:
    """Encode and write every document; rows (part, docs, tokens, width, base), one per file, base by prefix sums."""
    spark = docs.sparkSession
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part, out = encoder(tokenizer), TaskContext.get().partitionId(), Folder(folder)
        attempt = uuid.uuid4().hex
        names = {k: f"_tmp-{part:05d}-{attempt}.{k}" for k in ("bin", "idx", "doc", "nul")}
        end, width = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize
        n, at, files = 0, 0, None
        for b in batches:
            if files is None:
                files = {k: out.open(v) for k, v in names.items()}
                files["idx"].write(np.zeros(1, "<u8").tobytes())
            offsets = np.zeros(len(b), "<u8")
            for i, text in enumerate(b["t"]):
                ids = enc.encode(text or "")
                files["bin"].write(ids)
                files["bin"].write(end)
                at += len(ids) // width + 1
                offsets[i] = at
            missing = b["i"].isna().to_numpy()
            files["idx"].write(offsets.tobytes())
            files["doc"].write(np.array([int(x) if x is not None else 0 for x in b["i"]], "<i8").tobytes())
            files["nul"].write(missing.astype("u1").tobytes())
            n += len(b)
        if files is None:
            return
        for k, f in files.items():
            f.close()
            out.rename(names[k], f"part-{part:05d}.{k}")
        yield pd.DataFrame({"part": [part], "docs": [n], "tokens": [at], "width": [width]})

    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    parts = max(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                       F.monotonically_increasing_id().alias("u"))
    ordered = rows.repartitionByRange(parts, "k", "u").sortWithinPartitions("k", "u")
    written = stage(ordered.select(F.col("k").cast("string").alias("i"), "t")
                    .mapInPandas(run, "part int, docs long, tokens long, width int"))
    # one row per file: as few as there are partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_back(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the mapped files: doc_id, start, n_tokens and ids_crc32 (of 32-bit ids)."""
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = Folder(folder)
        for b in batches:
            for r in b.itertuples():
                stem = f"part-{r.part:05d}"
                ids = files.read(f"{stem}.bin", f"<u{r.width}")
                offsets, docs, null = (x[0:len(x)] for x in (
                    files.read(f"{stem}.idx", "<u8"), files.read(f"{stem}.doc", "<i8"), files.read(f"{stem}.nul", "u1")))
                offsets = offsets.astype(np.int64)
                if not (len(docs) == len(null) == len(offsets) - 1 == r.docs and len(ids) == offsets[-1] == r.tokens):
                    raise ValueError(f"{stem} does not have what its task reported")
                for at in range(0, r.docs, 10_000):
                    to = min(at + 10_000, r.docs)
                    sums = np.zeros(to - at, np.int64)
                    for i in range(at, to):
                        crc = 0
                        for j in range(int(offsets[i]), int(offsets[i + 1]), PIECE):
                            crc = zlib.crc32(ids[j:min(j + PIECE, int(offsets[i + 1]))].astype("<u4"), crc)
                        sums[i - at] = crc
                    yield pd.DataFrame({
                        "doc_id": [None if z else str(d) for d, z in zip(docs[at:to].tolist(), null[at:to], strict=True)],
                        "start": r.base + offsets[at:to], "n_tokens": np.diff(offsets[at:to + 1]), "ids_crc32": sums})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = manifest.repartition(parts, "part").mapInPandas(
        run, "doc_id string, start long, n_tokens long, ids_crc32 long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
