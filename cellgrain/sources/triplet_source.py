"""A Spark data source of triplet files: ``spark.read.format("triplets")`` and ``df.write.format("triplets")``.

A dataset is a folder with text files of lines gene, tab, cell, tab, value (each of one sample), and a manifest that names
the files which belong to it. Tasks write files under new names; the commit writes the next manifest beside the last and
renames it into place, so a reader sees all of a write or nothing of it, whatever tasks were lost, repeated or cut off.

Reading is dealt out by sample and range of bytes: a range owns the lines that begin in it. The options ``samples`` and
``genes`` (lists as JSON; see read()) choose files by the manifest, and rows of the parsed columns before Spark gets them. They are options
and no pushed filters, because Spark 4.1.2 keeps a filter that a Python source took for later plans over the same DataFrame, which then
lack rows.

Cases: a null sample, gene, cell or value, an empty name of a gene or cell, and one with a tab, a quote or a line end are errors
of the write, which then publishes nothing; repeated rows stay; an empty table publishes a manifest without files;
a folder without a manifest is an error of the read; further columns are an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "sample_id string, gene_id string, cell_id string, value double"
COLUMNS = {"sample_id": pa.string(), "gene_id": pa.string(), "cell_id": pa.string(), "value": pa.float64()}
#: Bytes of a range, and of one read inside of it.
SPLIT, READ = 64 << 20, 8 << 20
MANIFEST = "_manifest.json"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def manifest(path: str) -> list[dict] | None:
    """The files of a dataset; None where nothing was published."""
    files, root = opened(path)
    if files.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())["files"]


@dataclass
class Range(InputPartition):
    """Part of a file."""

    sample: str
    name: str
    start: int
    end: int

    def __post_init__(self) -> None:
        super().__init__(None)


def whole_lines(f: pa.NativeFile, start: int, end: int, step: int = READ) -> Iterator[bytes]:
    """The lines that begin in [start, end), some ``step`` bytes at a time."""
    at, rest = start, b""
    if start:  # the line around the start belongs to the range before, unless it begins here
        f.seek(start - 1)
        at = start - 1
        while True:
            data = f.read(1 << 16)
            if not data:
                return
            cut = data.find(b"\n")
            if cut >= 0:
                at += cut + 1
                break
            at += len(data)
    f.seek(at)
    while at < end:
        data = f.read(min(step, end - at))
        if not data:
            break
        at += len(data)
        data = rest + data
        cut = data.rfind(b"\n") + 1
        rest = data[cut:]
        if cut:
            yield data[:cut]
    while rest and not rest.endswith(b"\n"):  # the last line may end beyond the range
        data = f.read(1 << 16)
        if not data:
            break
        rest += data[: data.find(b"\n") + 1] or data
    if rest:
        yield rest


class TripletReader(DataSourceReader):
    def __init__(self, path: str, split: int, samples: list[str] | None, genes: list[str] | None):
        self.path, self.split, self.samples, self.genes = path, split, samples, genes

    def partitions(self) -> list[Range]:
        found = manifest(self.path)
        if found is None:
            raise FileNotFoundError(f"no triplets are published in {self.path}")
        samples = None if self.samples is None else set(self.samples)
        kept = [f for f in found if samples is None or f["sample"] in samples]
        return [Range(f["sample"], f["name"], at, min(at + self.split, f["bytes"])) for f in kept for at in range(0, f["bytes"], self.split)]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark asks so where there are no partitions
            return
        files, root = opened(self.path)
        parse = csv.ParseOptions(delimiter="\t", quote_char=False)
        names = csv.ReadOptions(column_names=["gene_id", "cell_id", "value"])
        # Every text is a name, "NA" and "null" too.
        kinds = csv.ConvertOptions(column_types={k: v for k, v in COLUMNS.items() if k != "sample_id"}, strings_can_be_null=False, null_values=[])
        wanted = None if self.genes is None else pa.array(self.genes, pa.string())
        with files.open_input_file(f"{root}/{partition.name}") as f:
            for block in whole_lines(f, partition.start, partition.end):
                table = csv.read_csv(pa.BufferReader(block), names, parse, kinds)
                if wanted is not None:
                    table = table.filter(pc.is_in(table["gene_id"], wanted))
                for b in table.to_batches():
                    if b.num_rows:
                        sample = pa.repeat(pa.scalar(partition.sample, pa.string()), b.num_rows)
                        yield pa.RecordBatch.from_arrays([sample, *b.columns], names=list(COLUMNS))


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class TripletWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One new file for each sample that the task has rows of."""
        files, root = opened(self.path)
        files.create_dir(f"{root}/data", recursive=True)
        options = csv.WriteOptions(include_header=False, delimiter="\t", quoting_style="none")
        mine, out = uuid.uuid4().hex, {}
        try:
            for batch in iterator:
                rows = pa.Table.from_batches([batch]).select(list(COLUMNS)).cast(pa.schema(COLUMNS.items()))
                check(rows)
                for sample in pc.unique(rows["sample_id"]).to_pylist():
                    if sample not in out:
                        name = f"data/{mine}-{len(out)}.tsv"
                        stream = files.open_output_stream(f"{root}/{name}")
                        out[sample] = (name, stream, csv.CSVWriter(stream, pa.schema({k: COLUMNS[k] for k in ("gene_id", "cell_id", "value")}.items()), write_options=options), [0])
                    part = rows.filter(pc.equal(rows["sample_id"], sample)).drop_columns(["sample_id"])
                    out[sample][2].write_table(part)
                    out[sample][3][0] += part.num_rows
        finally:
            for _, stream, writer, _ in out.values():
                writer.close()
                stream.close()
        done = [{"sample": s, "name": name, "rows": n[0], "bytes": files.get_file_info(f"{root}/{name}").size} for s, (name, _, _, n) in out.items()]
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        """Publishes what the tasks name, and nothing else that lies in the folder."""
        files, root = opened(self.path)
        found = [] if self.overwrite else manifest(self.path) or []
        found += [f for m in messages if m is not None for f in m.files]
        files.create_dir(root, recursive=True)
        draft = f"{root}/_{uuid.uuid4().hex}.json"
        with files.open_output_stream(draft) as f:
            f.write(json.dumps({"files": found}).encode())
        files.move(draft, f"{root}/{MANIFEST}")

    def abort(self, messages: list[Written | None]) -> None:
        files, root = opened(self.path)
        for m in messages:
            for f in m.files if m is not None else []:
                files.delete_file(f"{root}/{f['name']}")


def check(rows: pa.Table) -> None:
    """Raises where a row can't be a line."""
    for name in COLUMNS:
        if rows[name].null_count:
            raise ValueError(f"{name} has nulls")
    for name in ("gene_id", "cell_id"):
        if pc.any(pc.match_substring_regex(rows[name], r'^$|[\t\r\n"]')).as_py():
            raise ValueError(f"{name} has an empty name, or one with a tab, a quote or a line end")


class Triplets(DataSource):
    @classmethod
    def name(cls) -> str:
        return "triplets"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TripletReader:
        samples, genes = (json.loads(self.options[k]) if k in self.options else None for k in ("samples", "genes"))
        return TripletReader(self.options["path"].rstrip("/"), int(self.options.get("splitbytes", SPLIT)), samples, genes)

    def writer(self, schema: StructType, overwrite: bool) -> TripletWriter:
        if set(schema.names) != set(COLUMNS):
            raise ValueError(f"columns {schema.names} aren't {list(COLUMNS)}")
        return TripletWriter(self.options["path"].rstrip("/"), overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session."""
    spark.dataSource.register(Triplets)


def read(spark: SparkSession, path: str, samples: list[str] | None = None, genes: list[str] | None = None, split: int = SPLIT) -> DataFrame:
    """A dataset's rows, or those of some samples and genes (none of an empty list)."""
    register(spark)
    chosen = {k: json.dumps(v) for k, v in (("samples", samples), ("genes", genes)) if v is not None}
    return spark.read.format("triplets").options(splitBytes=split, **chosen).load(path)


def write(df: DataFrame, path: str, mode: str = "append") -> None:
    """Adds rows to a dataset, or replaces it (``mode`` overwrite)."""
    register(df.sparkSession)
    df.write.format("triplets").mode(mode).save(path)
