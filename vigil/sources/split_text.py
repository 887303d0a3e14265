"""One huge text file over many tasks, where a record may span line breaks and splits.

Whether a line break, a brace or a quote counts depends on all that stands before it, which is
why such files are usually read whole by one task. Here a file is cut at byte ranges into
pieces (lines, or the text up to each "}"), and every piece says what it does to the state:
how many quotes it has, how far it opens or closes, both if it begins outside and if it begins
inside a string. Sums of that over a split, and over the splits before it (one row
each), give every piece its state; then the pieces of one record are put together. The
largest thing any task holds is one split or one record.

JSON files are read anew for each of these steps, each split in order by one task, so that records
are neither stored nor shuffled on the way; only those that go over the end of a split leave their task.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.functions.jsonx import json_array, path
from vigil.session import ensure_checkpoint_dir, ship_by_value
from vigil.sources.delimited import na_tokens_to_null

_HERE = ("file", "block")


def pieces(spark: SparkSession, paths: str | list[str], sep: str) -> DataFrame:
    """file, block (where its split begins), at (increasing inside a split), value: the text
    between separators. Splits are Spark's: a file larger than one is read by several tasks."""
    ps = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("lineSep", sep).text(ps).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")


def _same_splits(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose readers cut files alike whenever their frames run, also
    if executors come and go or the settings change."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect: frames of two sessions do not go together
        return spark
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    if not own.conf.get("spark.sql.files.minPartitionNum", None):
        own.conf.set("spark.sql.files.minPartitionNum", own.conf.get("spark.sql.leafNodeDefaultParallelism", None) or str(cores))
    return own


def _count(text: Column, ch: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def _inside():
    """The pieces of a split from its first to this one."""
    return Window.partitionBy(*_HERE).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(df: DataFrame, sums: dict[str, str]) -> DataFrame:
    """``df`` (one row per split) with running sums over the file's earlier splits."""
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({out: F.coalesce(F.sum(F.expr(x)).over(w), F.lit(0)) for out, x in sums.items()})


def _together(rows: DataFrame, glue: str) -> DataFrame:
    """file, rid, text: the pieces of each record in order."""
    ordered = F.sort_array(F.collect_list(F.struct("block", "at", "value")))
    return rows.groupBy("file", "rid").agg(F.array_join(F.transform(ordered, lambda p: p["value"]), glue).alias("text"))


def read_quoted_csv(spark: SparkSession, paths: str | list[str], schema: StructType | str, sep: str = "|", na_tokens: bool = True) -> DataFrame:
    """CSV with a header line whose quoted fields may hold line breaks, without reading a file in one
    task. Quotes are doubled inside fields, so a line break ends a record exactly if an even
    number of quotes stands before it."""
    lines = pieces(spark, paths, "\n").withColumn("q", _count(F.col("value"), '"') % 2)
    par = (F.sum("q").over(_inside()) - F.col("q")) % 2
    lines = lines.withColumn("par", par)
    # records that begin up to here, if the split begins outside (0) or inside (1) quotes
    lines = lines.withColumns({f"n{s}": F.sum(F.when(F.col("par") == s, 1).otherwise(0)).over(_inside()) for s in (0, 1)})
    splits = lines.groupBy(*_HERE).agg(F.sum("q").alias("q"), F.max("n0").alias("n0"), F.max("n1").alias("n1"))
    splits = _before(splits, {"odd": "q"}).withColumn("odd", F.col("odd") % 2)
    splits = _before(splits, {"base": "CASE WHEN odd = 0 THEN n0 ELSE n1 END"}).select(*_HERE, "odd", "base")
    records = lines.join(splits, list(_HERE)).withColumn("rid", F.col("base") + F.when(F.col("odd") == 0, F.col("n0")).otherwise(F.col("n1")))
    text = _together(records.where("rid > 1"), "\n").withColumn("text", F.regexp_replace("text", r"\r\z", "")).where("text <> ''")
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    options = {"sep": sep, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    out = text.select(F.from_csv("text", _ddl(kind), options).alias("r")).select("r.*")
    return na_tokens_to_null(out) if na_tokens else out


def _ddl(kind: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)


#: Text that is looked at together in Python, about, in bytes.
_CHUNK = 1 << 22
_BLANKS = " \t\n\x0b\f\r"
_STEP = np.zeros(256, np.int8)
_STEP[[*b"{["]], _STEP[[*b"]}"]] = 1, -1
_MARK = _STEP != 0
_MARK[[*b'"\\']] = True
_BRACE, _QUOTE, _SLASH = b'}"\\'


def _chunks(batches, keys: tuple[str, ...]):
    """(values of ``keys``, text) of the pieces that stand after each other with the same keys, about
    ``_CHUNK`` bytes at once and whole pieces only; each piece ends with the brace after it."""
    for b in batches:
        value, n = b.column("value"), b.num_rows
        if n == 0:
            continue
        _, offsets, data = value.buffers()
        ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(value.type) else np.int32)[value.offset:value.offset + n + 1].astype(np.int64)
        text = np.frombuffer(data, np.uint8)
        new = np.zeros(n, bool)
        for c in _HERE:
            new[1:] |= pc.not_equal(b.column(c)[1:], b.column(c)[:-1]).to_numpy(zero_copy_only=False)
        starts = [0, *np.flatnonzero(new).tolist(), n]
        for lo, hi in zip(starts, starts[1:]):
            key = tuple(b.column(c)[lo].as_py() for c in keys)
            while lo < hi:
                to = lo + max(1, int(np.searchsorted(ends[lo + 1:hi + 1], ends[lo] + _CHUNK, "right")))
                yield key, text[ends[lo]:ends[to]]
                lo = to


def _marks(text):
    """Of the braces and brackets in ``text``: where they are, which are closing braces, what they add to the
    depth, and the parity of the quotes before them; and the number of quotes."""
    at = np.flatnonzero(_MARK[text])
    kind = text[at]
    slash = at[kind == _SLASH]
    if slash.size:  # what stands after an odd number of backslashes is escaped; no escape reaches over a brace
        first = np.flatnonzero(np.diff(slash, prepend=-2) != 1)
        length = np.diff(first, append=slash.size)
        after = (slash[first] + length)[length % 2 == 1]
        after = after[_MARK[text[after]] & (text[after] != _BRACE)]
        keep = kind != _SLASH
        keep[np.searchsorted(at, after)] = False
        at, kind = at[keep], kind[keep]
    quote = kind == _QUOTE
    odd = np.cumsum(quote) & 1
    at, kind, odd = at[~quote], kind[~quote], odd[~quote]
    return at, kind == _BRACE, _STEP[kind], odd, int(quote.sum())


def _summaries(key: str):
    """One row for each split of what it does to the state, if it begins outside (0) or inside (1) a string: the depth
    it adds (e), how often an object ends at each depth (n); the parity of its quotes (q), whether it names ``key``
    before an object, and whether its last piece is blank. The brace after a piece counts as there."""
    names = re.compile(b'"' + re.escape(key.encode()) + rb'"\s*:\s*\{')

    def run(batches):
        for (file, block), group in groupby(_chunks(batches, _HERE), itemgetter(0)):
            odd, named, e, n = 0, False, [0, 0], [Counter(), Counter()]
            for _, text in group:
                at, brace, step, inside, quotes = _marks(text)
                for s in (0, 1):
                    out = inside ^ odd == s
                    depth = e[s] + np.cumsum(np.where(out, step, 0), dtype=np.int64)
                    for d, k in zip(*(x.tolist() for x in np.unique(depth[out & brace], return_counts=True))):
                        n[s][d] += k
                    e[s] = int(depth[-1])
                odd ^= quotes & 1
                named = named or names.search(text) is not None
            braces = at[brace]
            last = text[braces[-2] + 1 if braces.size > 1 else 0:-1].tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array([file], pa.string()), pa.array([block], pa.int64()), pa.array([odd], pa.int32()), *(pa.array([x], pa.int64()) for x in e),
                *(pa.array([list(x.items())], pa.map_(pa.int64(), pa.int64())) for x in n), pa.array([named]), pa.array([not last.strip()])],
                ["file", "block", "q", "e0", "e1", "n0", "n1", "named", "blank"])

    return run


_SUMMARY = "file string, block long, q int, e0 long, e1 long, n0 map<long,long>, n1 map<long,long>, named boolean, blank boolean"
#: What a split begins with, and the records to take.
_BEGIN = (*_HERE, "odd", "base", "rid", "lo", "hi")


def _records_in_splits(level: int, edges: bool):
    """Records ``lo`` up to ``hi`` that follow a comma inside their split, as (source_file, record_pos, record)
    without it; with ``edges`` instead all else: (file, rid, block, value) of records that have another
    head or, piecemeal, go over the end of a split."""
    comma = rf"\A[{_BLANKS}]*,[{_BLANKS}]*\{{"

    def rows(file, rid, block, lo, text):
        source = pa.repeat(pa.scalar(file, pa.string()), len(text))
        if edges:
            return pa.RecordBatch.from_arrays([source, pa.array(rid, pa.int64()), pa.repeat(pa.scalar(block, pa.int64()), len(text)), text], ["file", "rid", "block", "value"])
        return pa.RecordBatch.from_arrays([source, pa.array(rid - lo, pa.int32()), pc.ascii_ltrim(text, characters="," + _BLANKS)], ["source_file", "record_pos", "record"])

    def run(batches):
        for (file, block, odd, depth, rid, lo, hi), group in groupby(_chunks(batches, _BEGIN), itemgetter(0)):
            begun, rest = block > 0, []  # whether the record began in an earlier split; its text so far
            for _, text in group:
                at, brace, step, inside, quotes = _marks(text)
                out = inside ^ odd == 0
                depths = depth + np.cumsum(np.where(out, step, 0), dtype=np.int64)
                ends = at[out & brace & (depths == level)] + 1
                odd, depth = odd ^ quotes & 1, int(depths[-1])
                if not ends.size:
                    rest.append(text.copy())
                    continue
                ends = ends + sum(map(len, rest))
                text = np.concatenate([*rest, text])
                rest = [text[ends[-1]:].copy()]
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                found = pa.Array.from_buffers(pa.string(), ends.size, [None, pa.py_buffer(offsets), pa.py_buffer(text)])
                ids = np.arange(rid, rid + ends.size)
                listed = pc.match_substring_regex(found, comma).to_numpy(zero_copy_only=False)
                if begun:
                    listed[0] = False
                take = (~listed if edges else listed) & (ids >= lo) & (ids < hi)
                if take.any():
                    yield rows(file, ids[take], block, lo, found.filter(pa.array(take)))
                rid, begun = rid + ends.size, False
            if edges and lo <= rid < hi and any(map(len, rest)):
                yield rows(file, [rid], block, lo, pa.array([np.concatenate(rest).tobytes()], pa.binary()).view(pa.string()))

    return run


def _json_splits(p: DataFrame, key: str, level: int) -> DataFrame:
    """One row for each split with the state it begins in (odd, base), the records that end before it (rid) and in
    its file (total), and whether the file's braces, brackets and quotes balance (whole) and its last brace ends
    it (closed)."""
    ensure_checkpoint_dir(p.sparkSession)
    splits = _before(p.mapInArrow(_summaries(key), _SUMMARY), {"odd": "q"}).withColumn("odd", F.col("odd") % 2)
    splits = splits.withColumn("e", F.when(F.col("odd") == 0, F.col("e0")).otherwise(F.col("e1"))).withColumn("n", F.when(F.col("odd") == 0, F.col("n0")).otherwise(F.col("n1")))
    splits = _before(splits, {"base": "e"}).withColumn("end", F.coalesce(F.element_at("n", F.lit(level) - F.col("base")), F.lit(0)))
    file = Window.partitionBy("file")
    # every file ends in a piece without a brace after it, which the brace counted for it gives away
    last = F.max(F.struct("block", (F.col("base") + F.col("e")).alias("depth"), ((F.col("odd") + F.col("q")) % 2 == 0).alias("closes"), "blank")).over(file)
    splits = _before(splits, {"rid": "end"}).withColumns({"last": last, "total": F.sum("end").over(file), "named": F.max("named").over(file)})
    closed = F.col("last.closes") & (F.col("last.depth") == 0)
    return splits.select(*_HERE, "odd", "base", "rid", "total", "named", closed.alias("closed"),
                         (closed | (F.col("last.closes") & (F.col("last.depth") == -1) & F.col("last.blank"))).alias("whole")).checkpoint()


def read_json_records(spark: SparkSession, paths: str | list[str], root_path: str) -> tuple[DataFrame, DataFrame]:
    """(records, bad files) of exports that hold one object or a list of them under ``root_path``
    (keys joined by dots): (source_file, record_pos, record) and (source_file, error_reason).

    The same records as ``nested_json.records`` over whole documents, for files of any size. A
    file counts as a document if its braces, brackets and quotes balance; a record must be
    an object, and the list's key must not be a list's key earlier in the document.

    The files are read anew for each step instead of being stored or dealt out: only a row for each split,
    records that go over the end of one, and documents with a lone record leave their task."""
    keys = root_path.split(".")
    level, key = len(keys) + 1, re.escape(keys[-1])
    p = pieces(_same_splits(spark), paths, "}")
    p = spark.createDataFrame([], p.schema).limit(0).union(p)  # a frame of the caller's session
    braced = p.select(*_HERE, F.concat("value", F.lit("}")).alias("value"))
    splits = _json_splits(braced, keys[-1], level)
    whole = splits.select("file", "whole").distinct()
    good = whole.where("whole").select("file")

    def scan(wanted: DataFrame, edges: bool) -> DataFrame:
        # splits are as few as the files' blocks, which the driver lists anyway
        wanted = wanted.select(*(F.col(c).cast("string" if c == "file" else "long") for c in _BEGIN))
        return braced.join(F.broadcast(wanted), list(_HERE)).select(*_BEGIN, "value").mapInArrow(
            _records_in_splits(level, edges), "file string, rid long, block long, value string" if edges else "source_file string, record_pos int, record string")

    parts = scan(splits.where("whole and total > 0").withColumns({"lo": F.lit(0), "hi": F.col("total")}), True)
    text = _together(parts.withColumn("at", F.lit(0)), "")
    # before a record stands a comma, or the head of the list that it is the first of
    listed = F.regexp_extract("text", rf'(?s)\A.*?"{key}"\s*:\s*\[\s*(\{{.*)\z', 1)
    comma = F.col("text").rlike(r"\A\s*,\s*\{")
    text = text.withColumn("head", F.when(~comma, F.when(listed != "", "list").otherwise("other"))) \
        .select("file", "rid", "head", F.when(comma, F.regexp_replace("text", r"\A\s*,\s*", "")).otherwise(listed).alias("record")).checkpoint()
    heads = text.where("head is not null").select("file", F.col("rid").alias("lo"), "head")
    heads = heads.withColumn("hi", F.lead("lo").over(Window.partitionBy("file").orderBy("lo"))).where("head = 'list'")
    first = heads.groupBy("file").agg(F.min(F.struct("lo", "hi")).alias("range")).select("file", "range.*")
    ranges = splits.join(first, "file").withColumn("hi", F.coalesce("hi", "total"))
    many = text.join(first, "file").where((F.col("rid") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("rid") < F.col("hi")))) \
        .select(F.col("file").alias("source_file"), (F.col("rid") - F.col("lo")).cast("int").alias("record_pos"), "record") \
        .unionByName(scan(ranges, False).withColumn("record", F.make_valid_utf8("record")))  # as the JVM's expressions leave the others
    # files whose root holds a lone object are one record, put together whole
    lone = splits.where("whole and named").select("file", "closed").distinct().join(first, "file", "left_anti")
    docs = _together(p.join(F.broadcast(lone.select("file")), "file").withColumn("rid", F.lit(0)), "}")
    # a file that ends in its last brace has no piece after it
    docs = docs.join(lone, "file").withColumn("text", F.concat("text", F.when(F.col("closed"), "}").otherwise("")))
    single = docs.select(F.col("file").alias("source_file"), F.posexplode(json_array(path("text", root_path))).alias("record_pos", "record"))
    records = many.unionByName(single)
    found = first.select("file").unionByName(single.select(F.col("source_file").alias("file")))
    bad = whole.where("not whole").select(F.col("file").alias("source_file"), F.lit("not a JSON document").alias("error_reason")).unionByName(
        good.join(found, "file", "left_anti").select(F.col("file").alias("source_file"), F.lit("root holds no records: " + root_path).alias("error_reason")))
    return records, bad


# the mapInArrow functions run in Python workers: ship this module's code by value
ship_by_value(sys.modules[__name__])
