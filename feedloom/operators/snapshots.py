"""Snapshot tables behind a commit log (H1-H8 for targets that stay).

A root holds all product tables. Each run is one commit:

* **Log.** ``manifest/v=<n>/commit.json`` is put if absent, so of two writers
  that start from one version exactly one gets the next; the other merges its
  batch again into what it lost to. A commit names its base files, its deltas, the
  next free id and, for each stream, the last batch it holds. What a run starts
  from is read from the log, never from a batch number, so a second job or a new
  checkpoint goes on where the tables stand, and a replayed batch finds its own
  commit.
* **Deltas.** A batch writes only the rows it changes: it reads the key columns
  of the buckets its keys fall in, looks up ids and currencies, and appends. The
  bytes written are in proportion to the batch.
* **Base.** When the deltas hold more than a quarter of the base, or are many, the
  commit folds them: it rewrites the buckets that they touch (:func:`fold` does
  so at any time). So a row is rewritten a bounded number of times for each
  doubling of the table.
* **Buckets** grow by linear hashing: with ``n`` buckets a key belongs to its
  hash modulo the next power of two, or half of that where this is ``n`` or
  more. A fold makes as many buckets as the rows need (``BUCKET_ROWS``) and
  rewrites the buckets that are split; no other key moves.

Ids are handed out from the commit's ``next_id``: a writer that loses the race
takes new ones, so no two commits ever share an id and none is left out.

``vacuum`` removes files that none of the last versions names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ATTRIBUTE_TABLES, CORE_COLUMNS, DEFAULT_CURRENCY, KEY_COLUMNS, PRESENCE_TABLES, SQL_TYPES
from ..session import scratch_scope, stage_table
from .ids import global_index
from .merge import CORE_ATTRS, CORE_OUT, FIRST, last_write_wins

KEY = list(KEY_COLUMNS)
TABLES = ["core", *ATTRIBUTE_TABLES, *PRESENCE_TABLES]
#: Buckets of a new root; rows of ``core`` in a bucket at most after a fold.
BUCKETS, BUCKET_ROWS = 16, 1 << 20
#: Deltas are folded when they hold more than 1/FOLD_PART of the base's rows, or
#: when there are more than MAX_DELTAS.
FOLD_PART, MAX_DELTAS = 4, 32
HASH = "key_hash"


# -- files ------------------------------------------------------------------------

def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def _rename(spark: SparkSession, draft, target) -> None:
    """A rename that fails if there is a file of that name."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, target, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file, or nothing if there is one of that name. The text
    goes to a file beside it first, which gets the name by a rename that does not
    overwrite (a hard link where the file system is local)."""
    fs, target = _path(spark, path)
    fs.mkdirs(target.getParent())
    _, draft = _path(spark, f"{target.getParent()}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    try:
        if target.toUri().getScheme() == "file":
            def local(p):
                return jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(target), local(draft))
        else:
            _rename(spark, draft, target)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _path(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


# -- the log ------------------------------------------------------------------------

def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions, ascending."""
    found = _listed(spark, f"{root}/manifest/v=*/commit.json")
    return sorted(int(p.split("/v=")[-1].split("/")[0]) for p in found)


def read_commit(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """The commit of a version; the latest one (None before the first) without.
    Raises if the version does not exist: it is never taken for empty tables."""
    if version is None:
        known = versions(spark, root)
        if not known:
            return None
        version = known[-1]
    fs, p = _path(spark, f"{root}/manifest/v={version}/commit.json")
    if not fs.exists(p):
        raise FileNotFoundError(f"snapshot version {version} does not exist under {root}")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put(spark: SparkSession, root: str, commit: dict) -> bool:
    return put_if_absent(spark, f"{root}/manifest/v={commit['version']}/commit.json", json.dumps(commit))


def _following(commit: dict | None) -> dict:
    """The next commit, so far with the same content."""
    if commit is None:
        return {"version": 0, "base": None, "deltas": [], "next_id": 1, "streams": {}}
    return dict(commit, version=commit["version"] + 1, deltas=list(commit["deltas"]), streams=dict(commit["streams"]))


# -- buckets ------------------------------------------------------------------------

def key_hash() -> Column:
    return F.hash(*KEY)


def bucket_of(h: Column, n: int) -> Column:
    """The bucket of a key hash among ``n`` (linear hashing)."""
    whole = 1 << max(0, (n - 1).bit_length())
    wide = F.pmod(h, F.lit(whole))
    return F.when(wide < n, wide).otherwise(F.pmod(h, F.lit(max(1, whole // 2)))).cast("int")


def _bucket(h: int, n: int) -> int:
    whole = 1 << max(0, (n - 1).bit_length())
    return h % whole if h % whole < n else h % (whole // 2)


def split_buckets(n: int, more: int) -> set[int]:
    """The buckets among ``n`` whose keys move when there are ``more``."""
    return {_bucket(k, n) for k in range(n, more)}


# -- reading ------------------------------------------------------------------------

def _columns(table: str) -> list[tuple[str, str]]:
    return [("product_id", "I"), *(CORE_COLUMNS if table == "core" else ATTRIBUTE_TABLES.get(table, []))]


def _schema(table: str) -> str:
    return ", ".join(f"{n} {SQL_TYPES[k]}" for n, k in _columns(table)) + f", {HASH} int"


def _entries(spark: SparkSession, root: str, commit: dict) -> list:
    """(table, bucket, dir, rows) of the base: one row a table and bucket."""
    return spark.read.parquet(f"{root}/base/w={commit['base']['dir']}").collect()


def _view(spark: SparkSession, root: str, commit: dict, entries: list, table: str, buckets: set[int] | None = None) -> DataFrame:
    """Rows of a table: the base (or the given buckets of it) without the
    products that a delta has, and the last delta row of each product."""
    names = [n for n, _ in _columns(table)] + [HASH]
    paths = [f"{root}/{table}/w={e.dir}/bucket={e.bucket}" for e in entries if e.table == table and (buckets is None or e.bucket in buckets)]
    base = (spark.read.schema(_schema(table)).option("basePath", f"{root}/{table}").parquet(*paths).select(*names) if paths
            else spark.createDataFrame([], _schema(table)))
    deltas = [spark.read.schema(_schema(table)).parquet(f"{root}/{table}/delta/w={d['dir']}").withColumn("__at", F.lit(i))
              for i, d in enumerate(commit["deltas"]) if d["rows"].get(table)]
    if not deltas:
        return base
    whole = deltas[0]
    for d in deltas[1:]:
        whole = whole.unionByName(d)
    last = whole.groupBy("product_id").agg(F.max_by(F.struct(*names[1:]), "__at").alias("x")).select("product_id", "x.*")
    return base.join(last.select("product_id"), "product_id", "left_anti").unionByName(last)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame] | None:
    """The tables of a version (the latest one; None before the first commit)."""
    commit = read_commit(spark, root, version)
    if commit is None:
        return None
    entries = _entries(spark, root, commit)
    return {t: _view(spark, root, commit, entries, t).drop(HASH) for t in TABLES}


# -- writing ------------------------------------------------------------------------

def _changed(folded: DataFrame, known: DataFrame, next_id: int) -> DataFrame:
    """H1, H2, H4: the batch's rows as they stand after the merge, with ids.

    ``known``: key, id and currency of the products whose keys the batch may
    hold. A known key takes every incoming attribute and keeps its currency where
    none comes; a new one gets the default currency and the next id, in
    first-seen order."""
    old = known.select(*KEY, "product_id", F.col("currency_code").alias("__old"))
    joined = stage_table(folded.join(old, KEY, "left"), "changed")
    is_new = F.col("product_id").isNull()
    currency = F.coalesce(F.col("currency_code"), F.when(is_new, F.lit(DEFAULT_CURRENCY)).otherwise(F.col("__old")))
    ids = global_index(joined.filter(is_new).select(*KEY, *FIRST), FIRST, "__id", base=next_id).select(*KEY, "__id")
    met = joined.withColumn("currency_code", currency).drop("__old")
    return met.filter(~is_new).unionByName(met.filter(is_new).drop("product_id").join(ids, KEY).withColumnRenamed("__id", "product_id"))


def _table_rows(changed: DataFrame, table: str) -> DataFrame:
    """H5-H7: the rows of a table that the changed products write."""
    if table == "core":
        return changed.select(*CORE_OUT, HASH)
    if table in ATTRIBUTE_TABLES:
        names = [n for n, _ in ATTRIBUTE_TABLES[table]]
        return changed.filter(F.col(f"{table}_rec").isNotNull()).select("product_id", *[F.col(f"{table}_rec.{n}").alias(n) for n in names], HASH)
    return changed.filter(F.col(f"in_{table}")).select("product_id", HASH)


def _append(spark: SparkSession, root: str, commit: dict, folded: DataFrame, name: str) -> dict:
    """The following commit with the batch as its newest delta ``name``."""
    new = _following(commit)
    entries = _entries(spark, root, commit)
    hashes = folded.select(bucket_of(F.col(HASH), commit["base"]["buckets"]))
    touched = {r[0] for r in hashes.distinct().collect()}  # as many as buckets at most
    changed = stage_table(_changed(folded, _view(spark, root, commit, entries, "core", touched), new["next_id"]), "delta")
    rows = {}
    for t in TABLES:
        path = f"{root}/{t}/delta/w={name}"
        _table_rows(changed, t).write.parquet(path)
        rows[t] = spark.read.schema(_schema(t)).parquet(path).count()
    new["deltas"].append({"dir": name, "rows": rows})
    return _with_next_id(new, changed)


def _with_next_id(new: dict, changed: DataFrame) -> dict:
    top = changed.agg(F.max("product_id")).first()[0]
    return dict(new, next_id=max(new["next_id"], (top or 0) + 1))


def _first(spark: SparkSession, root: str, folded: DataFrame, buckets: int, name: str) -> dict:
    """The first commit: the batch is the base ``name``."""
    new = _following(None)
    changed = stage_table(_changed(folded, spark.createDataFrame([], _schema("core")), new["next_id"]), "delta")
    more = max(buckets, -(-changed.count() // BUCKET_ROWS))
    new["base"] = _write_base(spark, root, name, {t: _table_rows(changed, t) for t in TABLES}, more, more, [])
    return _with_next_id(new, changed)


def _write_base(spark: SparkSession, root: str, name: str, tables: dict[str, DataFrame], buckets: int, tasks: int, kept: list[tuple]) -> dict:
    """Write the rows of rewritten buckets as base files ``name``, and the list of
    all base files; a bucket is bounded by BUCKET_ROWS, so one task can write it."""
    written = []
    for t, rows in tables.items():
        path = f"{root}/{t}/w={name}"
        rows.withColumn("bucket", bucket_of(F.col(HASH), buckets)).repartition(tasks, "bucket").write.partitionBy("bucket").parquet(path)
        counted = spark.read.schema(_schema(t) + ", bucket int").parquet(path).groupBy("bucket").count().collect()  # one row a bucket
        written += [(t, r["bucket"], name, r["count"]) for r in counted]
    spark.createDataFrame(kept + written, "table string, bucket int, dir string, rows long").coalesce(1).write.parquet(f"{root}/base/w={name}")
    return {"dir": name, "buckets": buckets, "rows": {t: sum(r for x, _, _, r in kept + written if x == t) for t in TABLES}}


def _is_due(commit: dict) -> bool:
    changed = sum(sum(d["rows"].values()) for d in commit["deltas"])
    return changed * FOLD_PART > sum(commit["base"]["rows"].values()) or len(commit["deltas"]) > MAX_DELTAS


def _folded(spark: SparkSession, root: str, commit: dict, name: str) -> dict:
    """The commit with its deltas folded into a base ``name``: the same rows.
    Buckets without a delta row and without a split keep their files."""
    entries = _entries(spark, root, commit)
    n = commit["base"]["buckets"]
    rows = commit["base"]["rows"]["core"] + sum(d["rows"]["core"] for d in commit["deltas"])
    more = max(n, -(-rows // BUCKET_ROWS))
    old = split_buckets(n, more)
    for d in commit["deltas"]:
        hashes = spark.read.schema(_schema("core")).parquet(f"{root}/core/delta/w={d['dir']}").select(bucket_of(F.col(HASH), n))
        old |= {r[0] for r in hashes.distinct().collect()}  # as many as buckets at most
    kept = [(e.table, e.bucket, e.dir, e.rows) for e in entries if e.bucket not in old]
    tables = {t: _view(spark, root, commit, entries, t, old) for t in TABLES}
    base = _write_base(spark, root, name, tables, more, max(1, len(old) + more - n), kept)
    return dict(commit, base=base, deltas=[])


def _drop(spark: SparkSession, root: str, name: str) -> None:
    for t in TABLES:
        _delete(spark, f"{root}/{t}/delta/w={name}")
        _delete(spark, f"{root}/{t}/w={name}")
    _delete(spark, f"{root}/base/w={name}")


def merge_batch(spark: SparkSession, root: str, ok_rows: DataFrame, stream: str | None = None, batch_id: int | None = None,
                buckets: int = BUCKETS, before_commit: Callable[[], None] | None = None) -> int:
    """H1-H7: merge a batch of ok rows into the tables under ``root``; returns
    its version.

    ``stream`` and ``batch_id`` name the batch of a stream: one that the log
    already holds is not merged again, and one whose predecessor the log does not
    hold is an error (the tables are not those the stream has written to).
    ``buckets``: buckets of a new root. ``before_commit`` is called before each
    try to commit.
    """
    with scratch_scope(spark):
        folded = stage_table(last_write_wins(ok_rows).withColumn(HASH, key_hash()), "folded")
        while True:
            commit = read_commit(spark, root)
            if stream is not None:
                held = commit["streams"].get(stream) if commit else None
                if held and held["batch"] >= batch_id:
                    return held["version"]
                if batch_id and (held is None or held["batch"] != batch_id - 1):
                    raise RuntimeError(f"batch {batch_id - 1} of stream {stream} does not exist in the snapshot log of {root}")
            names = [uuid.uuid4().hex for _ in range(2)]
            new = _first(spark, root, folded, buckets, names[0]) if commit is None else _append(spark, root, commit, folded, names[0])
            if _is_due(new):
                new = _folded(spark, root, new, names[1])
            if stream is not None:
                new["streams"][stream] = {"batch": batch_id, "version": new["version"]}
            if before_commit:
                before_commit()
            if _put(spark, root, new):
                return new["version"]
            for name in names:  # another writer was first
                _drop(spark, root, name)


def fold(spark: SparkSession, root: str) -> int | None:
    """Fold all deltas into the base, as a commit that changes no row; returns
    its version, None if there is nothing to fold or another writer was first."""
    commit = read_commit(spark, root)
    if commit is None or not commit["deltas"]:
        return None
    name = uuid.uuid4().hex
    new = dict(_folded(spark, root, commit, name), version=commit["version"] + 1)
    if _put(spark, root, new):
        return new["version"]
    _drop(spark, root, name)
    return None


def vacuum(spark: SparkSession, root: str, keep: int = 10, older_than_hours: float = 24.0) -> int:
    """Delete files that none of the last ``keep`` versions names and that are
    older than any run still at work may have written; returns how many folders."""
    import time

    known = versions(spark, root)
    commits = [read_commit(spark, root, v) for v in known[-keep:]]
    named = {d["dir"] for c in commits for d in c["deltas"]}
    for c in commits:
        named |= {c["base"]["dir"]} | {e.dir for e in _entries(spark, root, c)}
    gone = 0
    for pattern in ["base/w=*", *[f"{t}/w=*" for t in TABLES], *[f"{t}/delta/w=*" for t in TABLES]]:
        for path in _listed(spark, f"{root}/{pattern}"):
            fs, p = _path(spark, path)
            old = fs.getFileStatus(p).getModificationTime() <= (time.time() - older_than_hours * 3600) * 1000
            if old and path.rstrip("/").split("w=")[-1] not in named:
                gone += bool(fs.delete(p, True))
    for v in known[:-keep]:
        _delete(spark, f"{root}/manifest/v={v}")
    return gone
