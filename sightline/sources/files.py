"""Record files, Parquet details, samples, configuration, masks and hashes."""

from __future__ import annotations

import fnmatch
import json
import random
from pathlib import Path
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.text import url_stem
from sightline.operators.relational import numbered_spread
from sightline.session import discard, written


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """One JSON object per line, blank lines skipped. A line that is no object ends the query and names itself."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_file")).filter(F.trim("value") != "")
    body = F.trim("value")
    shaped = F.startswith(body, F.lit("{")) & F.endswith(body, F.lit("}")) & F.get_json_object(body, "$").isNotNull()
    bad = F.concat(F.lit("not a JSON object in "), F.col("_file"), F.lit(": "), F.substring("value", 1, 200))
    checked = F.when(shaped, F.col("value")).otherwise(F.raise_error(bad).cast("string"))
    return lines.select(F.from_json(checked, kind).alias("r")).select("r.*")


def read_annotations(spark: SparkSession, paths: list[str], url: str = "url", names: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Captions of several record files keyed by the stem of their URL.

    Rows without a caption are dropped. A name column that disagrees with the URL, or a key that stands twice, ends the
    query with an error.
    """
    columns = ", ".join(f"`{c}` string" for c in (url, "caption", *names))
    rows = read_records(spark, paths, columns).filter(F.trim(F.coalesce("caption", F.lit(""))) != "").withColumn("image_id", url_stem(F.col(url)))
    agree = F.lit(True)
    for n in names:
        agree &= F.regexp_extract(F.coalesce(n, F.lit("")), r"([^/]*?)(?:\.[^./]*)?$", 1) == F.col("image_id")
    said = F.when(agree, F.col("image_id")).otherwise(F.raise_error(F.concat(F.lit("file names disagree for "), "image_id")).cast("string"))
    keyed = rows.withColumn("image_id", said).groupBy("image_id").agg(F.count("*").alias("_n"), F.first("caption").alias("caption"))
    once = F.when(F.col("_n") == 1, F.col("caption")).otherwise(F.raise_error(F.concat(F.lit("annotated twice: "), "image_id")).cast("string"))
    return keyed.select("image_id", once.alias("caption"))


def with_ordinals(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The columns of a Parquet file with each row's physical place in its file, from 0; only these columns are read."""
    return spark.read.parquet(path).select(*columns, F.col("_metadata.row_index").alias("row_ordinal"))


def parquet_profile(spark: SparkSession, path: str) -> DataFrame:
    """file, row_groups, rows, bytes, columns, types ('name:type, ...') of every Parquet file under ``path``; footers are
    read by the tasks."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", F.col("length").alias("bytes"))

    def read(batches):
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for uri, size in zip(batch["path"], batch["bytes"]):
                fs, where = pafs.FileSystem.from_uri(uri)
                with fs.open_input_file(where) as f:
                    source = pq.ParquetFile(f)
                    m, fields = source.metadata, source.schema_arrow
                out.append((uri.rsplit("/", 1)[-1], m.num_row_groups, m.num_rows, int(size), m.num_columns, ", ".join(f"{x.name}:{x.type}" for x in fields)))
            import pandas as pd

            yield pd.DataFrame(out, columns=["file", "row_groups", "rows", "bytes", "columns", "types"])

    return files.mapInPandas(read, "file string, row_groups int, rows bigint, bytes bigint, columns int, types string")


def column_roles(df: DataFrame, candidates: dict[str, list[str]]) -> dict[str, str | None]:
    """For each role the first candidate among the columns, case aside."""
    have = {c.lower(): c for c in reversed(df.columns)}
    return {role: next((have[n.lower()] for n in names if n.lower() in have), None) for role, names in candidates.items()}


_BLOCK = 1 << 18  # draws that are made at once, and places that one task follows
_SLOTS = (1 << 22) - 1  # low bits of a place by which swaps are told that may concern it


def _draws(bits, first: int, last: int):
    """What ``random.shuffle`` draws for the places ``first`` down to ``last``: for place i a number from 0 to i.

    It is the first that is not above i among the leading bits of the generator's next words.
    """
    import numpy as np

    out = []
    i = first
    while i >= last:
        width = (i + 1).bit_length()
        wanted = i - max(last, (1 << (width - 1)) - 1) + 1  # as many have this width; a word gives one at most
        if width <= 32:
            values = (bits.random_raw(wanted) >> np.uint64(32 - width)).astype(np.int64)
        else:
            low, high = bits.random_raw(2 * wanted).reshape(-1, 2).T
            values = ((high >> np.uint64(64 - width)) << np.uint64(32) | low).astype(np.int64)
        taken = values <= i
        # i falls by one for each word taken before: repeated until it holds, which settles one more word at least each time.
        while not np.array_equal(taken, now := values <= i - (np.cumsum(taken) - taken)):
            taken = now
        out.append(values[taken])
        i -= len(out[-1])
    return np.concatenate(out)


def shuffled(n: int, seed: int, places: range):
    """Where the items at ``places`` stood before ``random.Random(seed).shuffle`` over n items.

    The swaps are undone from the last to the first for these places alone. The generator's state is kept once a block of
    draws and the blocks are drawn again backwards, so that memory follows the places and not n.
    """
    import numpy as np

    *words, pos = random.Random(seed).getstate()[1]
    bits = np.random.MT19937()
    bits.state = {"bit_generator": "MT19937", "state": {"key": np.array(words, dtype=np.uint32), "pos": pos}}
    blocks = []
    for first in range(n - 1, 0, -_BLOCK):
        if first < places.start:  # these swaps, the last ones, lie below all places
            break
        last = max(first - _BLOCK + 1, 1)
        blocks.append((first, last, bits.state))
        _draws(bits, first, last)
    at = {p: k for k, p in enumerate(places)}
    for first, last, state in reversed(blocks):
        bits.state = state
        i, j = np.arange(last, first + 1), _draws(bits, first, last)[::-1]
        if last >= places.stop:  # no place followed is an i that comes: only a j can meet one, or an i of this block
            held = np.zeros(_SLOTS + 1, dtype=bool)
            held[np.fromiter(at, np.int64, len(at)) & _SLOTS] = True
            near = held[j & _SLOTS] | (j >= last)
            i, j = i[near], j[near]
        for a, b in zip(i.tolist(), j.tolist()):
            if a != b and (a in at or b in at):
                from_a, from_b = at.pop(a, None), at.pop(b, None)
                if from_a is not None:
                    at[b] = from_a
                if from_b is not None:
                    at[a] = from_b
    before = np.empty(len(places), dtype=np.int64)
    before[np.fromiter(at.values(), np.int64, len(at))] = np.fromiter(at, np.int64, len(at))
    return before


def seeded_sample(df: DataFrame, key: str, start: int, end: int, seed: int) -> DataFrame:
    """Rows ``start`` to ``end`` of the keys in a seeded shuffle (Mersenne Twister over the sorted keys), with ordinal.

    The shuffle is one sequence by definition: each task goes through it once for up to 2^18 of the wanted places, with
    memory for these only (``shuffled``), and the keys are numbered in range parts. The driver gets their number alone.
    Keys are counted and the sampled ones stored when this is called. Repeated keys are an error.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"))
    n, most = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.max("_n")).first()
    if n and most > 1:
        raise ValueError("repeated keys")
    wanted = range(n)[start:end]
    pieces = [wanted[k : k + _BLOCK] for k in range(0, len(wanted), _BLOCK)]

    def follow(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            for k in batch["id"]:
                ordinals = np.arange(pieces[k].start, pieces[k].stop) - wanted.start + start
                yield pd.DataFrame({"_place": shuffled(n, seed, pieces[k]) + 1, "ordinal": ordinals})

    # Stored, so that the planner knows their size: it would take them for as few as the pieces and broadcast them.
    chosen = written(df.sparkSession.range(0, len(pieces), 1, max(1, len(pieces))).mapInPandas(follow, "_place bigint, ordinal int"), "chosen")
    keys = numbered_spread(df.select(F.col(key).alias("_key")), [], [F.col("_key").asc_nulls_first()], "_place", "bigint")
    found = written(keys.join(chosen, "_place").select("_key", "ordinal"), "sampled")
    discard(chosen)
    return df.join(found, df[key].eqNullSafe(found["_key"])).select(key, *[c for c in df.columns if c != key], "ordinal")


def merged_config(path: str, *overlays: str) -> dict:
    """A configuration file with overlays merged key by key; JSON, or YAML where a reader is installed. Each must exist."""

    def read(p: str) -> dict:
        text = Path(p).read_text()
        if p.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("no YAML reader is installed") from e
            return yaml.safe_load(text) or {}
        return json.loads(text)

    def merge(a: dict, b: dict) -> dict:
        return a | {k: merge(a[k], v) if isinstance(v, dict) and isinstance(a.get(k), dict) else v for k, v in b.items()}

    out = read(path)
    for o in overlays:
        out = merge(out, read(o))
    return out


def mask_boxes(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Tight boxes of masks given as pixels (x, y, value): the non-zero ones, ends excluded. No row for empty masks."""
    return pixels.filter("value > 0").groupBy(*keys).agg(F.min("x").cast("double").alias("x1"), F.min("y").cast("double").alias("y1"), (F.max("x") + 1).cast("double").alias("x2"), (F.max("y") + 1).cast("double").alias("y2"))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file with their ordinal: id, ordinal (within one file)."""
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("ordinal", "id")).filter("id <> ''").select("id", "ordinal")


def file_hashes(spark: SparkSession, path: str, pattern: str = "*", chunk: int = 1 << 20) -> DataFrame:
    """file, sha256 of every file under ``path``; ``file`` is its path below ``path``, or its name if ``path`` is a file.

    Empty files and names that begin with a dot or underscore count too. Only names are listed on the driver; each task
    streams its files in pieces of ``chunk`` bytes, so their size is not bounded by that of a cell.
    """
    import pyarrow.fs as pafs

    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root = quote(named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(named).toString(), safe="/:@")
    fs, where = pafs.FileSystem.from_uri(root)
    top = fs.get_file_info(where)
    if top.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [top] if top.is_file else [f for f in fs.get_file_info(pafs.FileSelector(where, recursive=True)) if f.is_file]
    rows = [(f.path, f.base_name if top.is_file else f.path[len(where.rstrip("/")) + 1 :]) for f in sorted(found, key=lambda f: -f.size) if fnmatch.fnmatchcase(f.base_name, pattern)]
    slices = max(1, min(len(rows), 8 * spark.sparkContext.defaultParallelism))
    # Dealt by size, so that the largest files do not meet in one task.
    listed = spark.createDataFrame(spark.sparkContext.parallelize([r for k in range(slices) for r in rows[k::slices]], slices), "path string, file string")

    def read(batches):
        import hashlib

        import pandas as pd

        source, _ = pafs.FileSystem.from_uri(root)
        for batch in batches:
            out = []
            for at, name in zip(batch["path"], batch["file"]):
                digest = hashlib.sha256()
                with source.open_input_stream(at, compression=None) as f:
                    while piece := f.read(chunk):
                        digest.update(piece)
                out.append((name, digest.hexdigest()))
            yield pd.DataFrame(out, columns=["file", "sha256"])

    return listed.mapInPandas(read, "file string, sha256 string")
