"""Recording files as tables: catalog, headers, sampled streams, manifests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, length) of the files under ``root``; their content is never read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length")


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """A row for each probe: its number, the paths and the size of its .ap.bin and .ap.meta; either may be missing."""
    kinds = [files(spark, root, f"*.ap.{kind}").select(F.regexp_extract("path", r"_imec(\d+)", 1).cast("int").alias("probe"), F.col("path").alias(f"{kind}_path"), F.col("length").alias(f"{kind}_bytes")) for kind in ("bin", "meta")]
    return kinds[0].join(kinds[1], "probe", "full_outer").orderBy("probe")


def pairs_of(found: DataFrame) -> DataFrame:
    """(stem, bin_path, meta_path, status) of the .nidq files among ``found`` (path, length): a row for each stem, ``ok`` if both are there."""
    named = found.where(F.col("path").rlike(r"\.nidq\.(bin|meta)$")).select("path", F.regexp_replace("path", r"\.(bin|meta)$", "").alias("stem"))
    both = named.groupBy("stem").agg(*(F.max(F.when(F.col("path").endswith(f".{kind}"), F.col("path"))).alias(f"{kind}_path") for kind in ("bin", "meta")))
    return both.withColumn("status", F.when(F.col("bin_path").isNull(), "bin_missing").when(F.col("meta_path").isNull(), "meta_missing").otherwise("ok"))


def headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, key, value) of ``key=value`` headers: blank lines, # lines and lines without = are skipped, the first = parts."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.trim("value").alias("line"))
    part = F.split("line", "=", 2)
    return lines.where("line <> '' AND line NOT LIKE '#%' AND line LIKE '%=%'").select("path", F.trim(part[0]).alias("key"), F.trim(part[1]).alias("value"))


def wide(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each file with a column for each of the known keys."""
    return rows.groupBy("path").pivot("key", list(keys)).agg(F.first("value"))


def recording_date(created: Column) -> Column:
    """YYMMDD of a time stamp that has both a date and a time of day, else null."""
    return F.when(created.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d"), F.date_format(F.try_to_timestamp(created), "yyMMdd"))


def duration_s(seconds: Column, size: Column, channels: Column, rate: Column) -> Column:
    """The header's duration, or what the file's size gives."""
    return F.coalesce(seconds.try_cast("double"), size / (channels * 2) / rate)


def session_durations(probes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The longest duration among the probes of a session; null where no probe has one."""
    return probes.groupBy(*keys).agg(F.max("duration_s").alias("duration_s"), F.count("*").alias("n_probes"))


def checks(found: DataFrame) -> DataFrame:
    """(probe, check, status, detail) for a catalog joined with its headers (columns fileSizeBytes, imSampRate)."""
    def row(check: str, ok: Column, detail: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise("fail").alias("status"), detail.cast("string").alias("detail"))
    rows = F.array(
        row("bin_present", F.col("bin_path").isNotNull(), F.col("bin_path")), row("meta_present", F.col("meta_path").isNotNull(), F.col("meta_path")),
        row("size_matches", F.col("bin_bytes") == F.col("fileSizeBytes").try_cast("long"), F.col("bin_bytes")), row("rate_present", F.col("imSampRate").isNotNull(), F.col("imSampRate")))
    return found.select("probe", F.explode(rows).alias("r")).select("probe", "r.*")


class SampleSource(DataSource):
    """Interleaved int16 samples as rows (chunk_id, channel, start_sample, n_samples, data), a partition for each range of chunks.

    Options: path, channels, chunk (samples), chunks (to a partition), and, for a slice,
    first and last (samples: chunks that touch [first, last)) and wanted (numbers of
    channels, with commas).  ``channel`` is -1 for whole chunks, all channels interleaved.
    A slice is known when partitions are planned, so only its byte ranges are read and
    only the wanted channels are built.  These are options and no pushed filters, as Spark
    4.1 keeps what was pushed into a reader for all later uses of the same DataFrame.
    The path is one that every executor can open, or a URI of a file system that Arrow knows.
    """

    @classmethod
    def name(cls) -> str:
        return "samples"

    def schema(self) -> str:
        return "chunk_id long, channel int, start_sample long, n_samples long, data array<smallint>"

    def reader(self, schema) -> DataSourceReader:
        return SampleReader(self.options)


class SampleReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.channels = options["path"], int(options["channels"])
        self.chunk, self.per = int(options.get("chunk", "30000")), int(options.get("chunks", "64"))
        self.first, self.last = int(options.get("first", "0")), int(options["last"]) if "last" in options else None
        self.wanted = [int(c) for c in options["wanted"].split(",")] if "wanted" in options else [-1]

    def file(self):
        return pafs.FileSystem.from_uri(self.path) if "://" in self.path else (pafs.LocalFileSystem(), self.path)

    def partitions(self) -> list[InputPartition]:
        system, path = self.file()
        samples = system.get_file_info(path).size // (2 * self.channels)
        n = -(-samples // self.chunk)
        low = max(0, self.first) // self.chunk
        high = n if self.last is None else min(n, -(-self.last // self.chunk))
        return [InputPartition((first, min(first + self.per, high), samples)) for first in range(low, high, self.per)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:  # no partition was planned
            return
        first, last, samples = partition.value
        names = ["chunk_id", "channel", "start_sample", "n_samples", "data"]
        system, path = self.file()
        with system.open_input_file(path) as file:
            file.seek(2 * self.channels * first * self.chunk)
            for i in range(first, last):
                n = min(self.chunk, samples - i * self.chunk)
                data = np.frombuffer(file.read(2 * self.channels * n), dtype="<i2")
                for c in self.wanted:
                    if not -1 <= c < self.channels:
                        continue
                    values = data if c < 0 else data[c :: self.channels].copy()
                    lists = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([c], pa.int32()), pa.array([i * self.chunk], pa.int64()), pa.array([n], pa.int64()), lists], names=names)


def sample_slice(spark: SparkSession, path: str, channels: int, rate: float, start_s: float, end_s: float, wanted: Sequence[int], **options: str) -> DataFrame:
    """(channel, start_sample, n_samples, data) of some channels in [start_s, end_s), bounds rounded to samples; chunks at the ends are cut."""
    first, last = round(start_s * rate), round(end_s * rate)
    if not 0 <= first < last:
        raise ValueError("a slice begins at 0 or later and ends after it begins")
    spark.dataSource.register(SampleSource)
    held = spark.read.format("samples").options(path=path, channels=str(channels), first=str(first), last=str(last), wanted=",".join(map(str, wanted)), **options).load()
    low = F.greatest("start_sample", F.lit(first))
    n = F.least(F.col("start_sample") + F.col("n_samples"), F.lit(last)) - low
    cut = held.select("channel", low.alias("start_sample"), n.alias("n_samples"), F.slice("data", (low - F.col("start_sample") + 1).cast("int"), n.cast("int")).alias("data"))
    return cut.where("n_samples > 0")


def channel(chunks: DataFrame, number: int, channels: int) -> DataFrame:
    """One channel of interleaved chunks."""
    picked = F.filter("data", lambda _, i: i % channels == number)
    return chunks.withColumn("data", picked)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(stim_index, stim_name): lines of a tab-separated file with a header, numbered from 1 in the file's order; texts stay as they are."""
    rows = spark.read.option("sep", "\t").option("header", "true").option("inferSchema", "false").option("nullValue", "\0").csv(path)
    if "FileName" not in rows.columns:
        raise ValueError("the manifest has no column FileName")
    # partitions of one file are in its order: a row's number is its place in its partition and the rows before that one
    place = F.monotonically_increasing_id()
    placed = rows.select(F.shiftright(place, 33).alias("_part"), (place.bitwiseAND((1 << 33) - 1)).alias("_at"), F.col("FileName").alias("stim_name"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(parts, "_part").select((F.col("_before") + F.col("_at") + 1).alias("stim_index"), "stim_name").orderBy("stim_index")


def resolved(wanted: DataFrame, found: DataFrame, vaults: Sequence[str]) -> DataFrame:
    """(name, path, source): each dataset name by its own path, else by its file name in the first vault that has it.

    ``source`` is direct, vault:<root>, vault:<root>(multi) where the vaults hold several, vault_miss or no_dataset_name.
    """
    clean = F.regexp_replace("name", r"\\", "/")
    names = wanted.select("name", clean.alias("_direct"), F.element_at(F.split(clean, "/"), -1).alias("_file"))
    have = found.select(F.regexp_replace("path", "^file:/*", "/").alias("path")).withColumn("_file", F.element_at(F.split("path", "/"), -1))
    rank = F.coalesce(*(F.when(F.col("path").startswith(v.rstrip("/") + "/"), i) for i, v in enumerate(vaults)), F.lit(None).cast("int"))
    in_vault = have.withColumn("_v", rank).where("_v IS NOT NULL")
    order = Window.partitionBy("_file").orderBy("_v", "path")
    best = in_vault.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_file"))).withColumn("_k", F.row_number().over(order)).where("_k = 1").select("_file", F.col("path").alias("_vault"), "_v", "_n")
    joined = names.join(have.select(F.col("path").alias("_direct"), F.lit(True).alias("_is")).distinct(), "_direct", "left").join(best, "_file", "left")
    root = F.element_at(F.array(*(F.lit(v) for v in vaults)), F.col("_v") + 1)
    source = F.when(F.coalesce(F.trim("name"), F.lit("")) == "", "no_dataset_name").when(F.col("_is"), "direct").when(F.col("_n") > 1, F.concat(F.lit("vault:"), root, F.lit("(multi)"))).when(F.col("_n") == 1, F.concat(F.lit("vault:"), root)).otherwise("vault_miss")
    return joined.select("name", F.when(source == "direct", F.col("_direct")).when(source.startswith("vault:"), F.col("_vault")).alias("path"), source.alias("source"))


def spike_samples(units: DataFrame, rates: DataFrame, default_rate: float | None = None) -> DataFrame:
    """(probe_id, unit_id, sample): spike times in seconds to samples, rounded half to even; a probe without a rate raises."""
    rate = F.coalesce(F.lit(default_rate), "rate", F.raise_error(F.concat(F.lit("no sampling rate for "), F.col("probe_id"))).cast("double"))
    times = units.select("probe_id", "unit_id", F.explode("spike_times").alias("t")).join(rates, "probe_id", "left")
    return times.select("probe_id", "unit_id", F.rint(F.col("t") * rate).cast("long").alias("sample"))


#: A behaviour trial as it is logged.
TRIAL = "session string, trial_id long, valid boolean, events array<struct<code: string, time: double>>, analog map<string, array<double>>, vars map<string, string>"


def behaviour_trials(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    """Nested behaviour trials from JSON lines or Parquet, with the columns of TRIAL; fields that a file lacks are null, a line that is none or a trial without an id raises."""
    reader = spark.read.schema(TRIAL)
    rows = reader.option("mode", "FAILFAST").json(path) if form == "json" else reader.parquet(path)
    number = F.coalesce("trial_id", F.raise_error(F.lit("a behaviour trial has no trial_id")).cast("long"))
    return rows.withColumn("trial_id", number)


def summary(units: DataFrame, trials: DataFrame) -> DataFrame:
    """Per session: counts, probes, and which modes the tables allow."""
    u = units.groupBy("session").agg(F.count("*").alias("n_units"), F.array_sort(F.collect_set("probe_id")).alias("probes"))
    t = trials.groupBy("session").agg(F.count("*").alias("n_trials"))
    both = u.join(t, "session", "full_outer").select("session", F.coalesce("n_units", F.lit(0)).alias("n_units"), F.coalesce("probes", F.array().cast("array<string>")).alias("probes"), F.coalesce("n_trials", F.lit(0)).alias("n_trials"))
    return both.withColumn("can_score", (F.col("n_units") > 0) & (F.col("n_trials") > 0))


def require_mode(found: DataFrame, mode: str) -> DataFrame:
    """``found``, a summary, raising at a session that lacks what a mode (units, trials) needs."""
    needs = {"units": "n_units > 0", "trials": "n_units > 0 AND n_trials > 0"}[mode]
    return found.where(F.when(F.expr(needs), True).otherwise(F.raise_error(F.concat(F.lit(f"no {mode} in session "), F.col("session"))).cast("boolean")))


def unit_updates(spark: SparkSession, path: str) -> DataFrame:
    """Updates by unit_id from a CSV file; a repeated id or a column of spike times raises."""
    rows = spark.read.option("header", "true").csv(path)
    if "unit_id" not in rows.columns or "spike_times" in rows.columns:
        raise ValueError("updates need unit_id and must not have spike_times")
    if not rows.groupBy("unit_id").count().where("count > 1").isEmpty():
        raise ValueError("a unit_id occurs twice")
    return rows.withColumn("unit_id", F.col("unit_id").cast("long"))


def tolerant_boolean(text: Column) -> Column:
    """true, 1, yes, y and t, and their opposites, without regard to case; blank is null; anything else raises."""
    low = F.lower(F.trim(text.cast("string")))
    return F.when(low.isNull() | low.isin("", "nan", "none", "null"), F.lit(None).cast("boolean")).when(low.isin("true", "1", "1.0", "yes", "y", "t"), True).when(low.isin("false", "0", "0.0", "no", "n", "f"), False).otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), low)).cast("boolean"))


def vector(text: Column) -> Column:
    """Numbers in a text such as ``[1.5, 2]`` or ``[ 1.5  2 ]``."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"[-+]?\d+(?:\.\d*)?(?:[eE][-+]?\d+)?"), F.lit(0)), lambda x: x.cast("double"))
