"""Reading and writing the relay's tables and message files."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outflow import schemas

#: Folder of published messages beside a state's versions.
MESSAGES = "messages"
#: What the names of staged folders begin with.
STAGED = "outflow-"
#: Folder of recovery plans there.
PLANS = "plans"
#: What the name of a compacted version ends in.
WHOLE = "-whole"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, found by name without regard to case; order and extra columns don't matter.

    A missing column, or one of another kind of type, is an error.
    """
    by_name: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in by_name and name.lower() in {f.name for f in schema}:
            raise ValueError(f"column {name!r} is ambiguous")
        by_name[name.lower()] = name
    missing = [f.name for f in schema if f.name not in by_name]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    out = []
    for field in schema:
        have = df.schema[by_name[field.name]].dataType
        whole = isinstance(have, T.IntegralType | T.DecimalType) and isinstance(field.dataType, T.IntegralType | T.DecimalType)
        if have != field.dataType and not whole:
            raise ValueError(f"column {field.name} is {have.simpleString()}, not {field.dataType.simpleString()}")
        out.append(F.col(f"`{by_name[field.name]}`").cast(field.dataType).alias(field.name))
    return df.select(*out)


def add_managed_columns(df: DataFrame, managed: dict | None = None) -> DataFrame:
    """Adds the managed columns an older outbox (or, with its own dictionary, checkpoint) table lacks."""
    kinds = {f.name: f.dataType for f in [*schemas.OUTBOX, *schemas.CHECKPOINT]}
    have = {c.lower() for c in df.columns}
    for name, default in (schemas.OUTBOX_MANAGED if managed is None else managed).items():
        if name not in have:
            df = df.withColumn(name, F.lit(default).cast(kinds[name]))
    return df


def read_outbox(spark: SparkSession, path: str | None = None, jdbc: dict | None = None) -> DataFrame:
    """The outbox table, from Parquet or over JDBC (options as Spark's reader takes them).

    Over JDBC the table is read in ranges of its ids (see ``id_ranges``) where the
    options name no partitioning; ``ranges`` among the options says how many.
    """
    if not jdbc:
        return conform(spark.read.parquet(path), schemas.OUTBOX)
    options = {k: v for k, v in jdbc.items() if k not in ("ranges", "url", "dbtable", "id_column")}
    if "partitionColumn" in jdbc or "query" in jdbc:
        return conform(spark.read.format("jdbc").options(**{k: v for k, v in jdbc.items() if k not in ("ranges", "id_column")}).load(), schemas.OUTBOX)
    column = jdbc.get("id_column", "id")
    predicates = id_ranges(spark, jdbc, column, int(jdbc.get("ranges", spark.conf.get("spark.sql.shuffle.partitions"))))
    return conform(_database_types(spark.read.jdbc(jdbc["url"], jdbc["dbtable"], predicates=predicates, properties=options)), schemas.OUTBOX)


def id_ranges(spark: SparkSession, jdbc: dict, column: str, n: int) -> list[str]:
    """Up to ``n`` conditions that deal a table's rows out by id, each row in exactly one.

    The database says the least and largest id; the ids alone are read once, in
    equal ranges of numbers, and cut at their quantiles, so that gaps in the ids
    leave no range empty or overfull.  Ids are unsigned 64-bit numbers, which no
    ``partitionColumn`` of Spark's reader can hold.
    """
    options = {k: v for k, v in jdbc.items() if k not in ("ranges", "url", "dbtable", "id_column")}
    ask = spark.read.format("jdbc").options(**options, url=jdbc["url"]).option("query", f"select min({column}) as lo, max({column}) as hi from {jdbc['dbtable']}")
    low, high = ask.load().collect()[0]
    if low is None or n < 2 or low == high:
        return ["1 = 1"]
    low, high = int(low), int(high)
    even = _within(column, sorted({low + (high - low) * k // n for k in range(1, n)}))
    ids = spark.read.jdbc(jdbc["url"], f"(select {column} from {jdbc['dbtable']}) ids", predicates=even, properties=options)
    cuts = ids.agg(F.percentile_approx(F.col(ids.columns[0]).cast(schemas.ID), [k / n for k in range(1, n)], 10_000).alias("c")).first()["c"]
    return _within(column, sorted({int(c) for c in cuts} - {high}))


def _within(column: str, cuts: list[int]) -> list[str]:
    edges = [None, *cuts, None]
    return [" and ".join(([f"{column} > {a}"] if a is not None else []) + ([f"{column} <= {b}"] if b is not None else [])) or "1 = 1" for a, b in zip(edges, edges[1:], strict=False)]


def _database_types(df: DataFrame) -> DataFrame:
    """Columns as the outbox has them: names in any case, numbers of any width or scale zero, texts held as bytes and the other way."""
    want = {f.name: f.dataType for f in schemas.OUTBOX}
    out = []
    for field in df.schema:
        kind, have = want.get(field.name.lower()), field.dataType
        column = F.col(f"`{field.name}`")
        if isinstance(kind, T.StringType) and isinstance(have, T.BinaryType):
            column = column.cast("string")
        elif isinstance(kind, T.BinaryType) and isinstance(have, T.StringType):
            column = F.encode(column, "UTF-8")
        elif isinstance(kind, T.TimestampType) and isinstance(have, T.TimestampNTZType):
            column = column.cast("timestamp")
        out.append(column.alias(field.name))
    return df.select(*out)


def read_change_log(spark: SparkSession, path: str) -> DataFrame:
    """A bounded change log."""
    return spark.read.schema(schemas.CHANGE_LOG).parquet(path)


def stream_change_log(spark: SparkSession, path: str, files_per_batch: int = 16, start: DataFrame | None = None) -> DataFrame:
    """An unbounded change log; a query's checkpoint remembers how far it came.

    ``start``: where sources begin (see ``after_start``), read when the stream is made.
    """
    events = spark.readStream.schema(schemas.CHANGE_LOG).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return events if start is None else after_start(events, start)


def after_start(events: DataFrame, start: DataFrame) -> DataFrame:
    """Events of the sources in ``start`` that come after their position there; other sources' go.

    ``start`` (one row a source): source_id, binlog_name, binlog_position,
    gtid_set.  A source with a GTID set begins with its log's first file, as the
    set alone says what is consumed (``stream_transactions`` drops it); one
    without begins behind the position.  What only the file decides is a filter
    of its own, so that a log laid out by source_id and log_file has whole
    folders pruned.
    """
    file, whole = F.lit(False), F.lit(False)
    number = file_number(F.col("log_file"))
    for r in start.select("source_id", "binlog_name", "binlog_position", "gtid_set").collect():
        mine = F.col("source_id") == r["source_id"]
        if r["gtid_set"]:
            file, whole = file | mine, whole | mine
            continue
        first = file_number(F.lit(r["binlog_name"]))
        file = file | (mine & (number >= first))
        whole = whole | (mine & ((number > first) | (F.col("log_pos") > r["binlog_position"])))
    return events.where(file).where(whole)


def file_number(name: Column) -> Column:
    """The number a log file's name ends in; files of a source follow it."""
    return F.regexp_extract(name, r"([0-9]+)\z", 1).try_cast("long")


def index_log(spark: SparkSession, path: str, index: str) -> int:
    """Adds the zones of the log's data files that the index lacks; returns how many files were new.

    A zone says which positions of a source's log file a data file holds.  To be
    called when files have come; only their three columns are read.
    """
    fs, root = _pointer(spark, path)
    listed, found = [], fs.listFiles(root, True)
    while found.hasNext():
        at = found.next().getPath()
        if at.getName().endswith(".parquet") and not at.getName().startswith(("_", ".")):
            listed.append((at.toString(), _plain_uri(at.toUri().toString())))
    known = {r["file"] for r in spark.read.schema(ZONES).parquet(index).select("file").distinct().collect()} if exists(spark, index) else set()
    fresh = sorted(f for f in listed if f[0] not in known)
    if fresh:
        read = spark.read.schema(schemas.CHANGE_LOG).parquet(*(f for f, _ in fresh)).select("source_id", "log_file", "log_pos", F.col("_metadata.file_path").alias("file"))
        zones = read.groupBy("file", "source_id", "log_file").agg(F.min("log_pos").alias("low"), F.max("log_pos").alias("high"))
        # Paths as they were listed: as a reader tells them they are written in another way.
        named = spark.createDataFrame(fresh, "listed string, uri string")
        zones = zones.withColumn("uri", F.regexp_replace("file", SCHEME, "$1:/")).join(named, "uri")
        zones = zones.select(F.col("listed").alias("file"), "source_id", "low", "high", "log_file", _shelf(F.col("log_file")).alias("shelf"))
        zones.coalesce(1).write.mode("append").partitionBy("shelf").parquet(index)
    return len(fresh)


#: A path's scheme, with one slash or three behind it.
SCHEME = r"\A([A-Za-z0-9]+):/+"


def _plain_uri(uri: str) -> str:
    return re.sub(SCHEME, r"\1:/", uri)


ZONES = "file string, source_id string, low long, high long, log_file string, shelf long"
#: Log files whose zones lie in one folder of the index.
SHELF = 1024


def _shelf(log_file: Column) -> Column:
    """The folder of the index where a log file's zones lie: a folder for each file would cost more than the zones in it."""
    return F.coalesce(F.floor(file_number(log_file) / SHELF), F.lit(-1)).cast("long")


def log_at(spark: SparkSession, index: str, spans: list[tuple[str, str, int, int]]) -> DataFrame:
    """The log's data files that hold any of the spans (source, log file, least and largest position), read whole."""
    wanted = spark.createDataFrame(spans, "source_id string, log_file string, first long, last long")
    shelves = [r[0] for r in wanted.select(_shelf(F.col("log_file"))).distinct().collect()]
    zones = spark.read.schema(ZONES).parquet(index).where(F.col("shelf").isin(shelves)) if shelves else None
    files = [] if zones is None else sorted(r["file"] for r in zones.join(wanted, ["source_id", "log_file"]).where("low <= last and high >= first").select("file").distinct().collect())
    return spark.read.schema(schemas.CHANGE_LOG).parquet(*files) if files else spark.createDataFrame([], schemas.CHANGE_LOG)


def indexed_log(path: str, index: str) -> Callable[[SparkSession, list], DataFrame]:
    """A reader of spans of a log for the relay; it looks at files that came since first."""

    def read(spark: SparkSession, spans: list) -> DataFrame:
        index_log(spark, path, index)
        return log_at(spark, index, spans)

    return read


def to_envelope(messages: DataFrame, stable_id: Column, headers: Column | None = None, expected_stream: str | None = None, id_header: str = "Nats-Msg-Id", ttl_header: str = "Nats-TTL", stream_header: str = "Nats-Expected-Stream", keep: tuple[str, ...] = ()) -> DataFrame:
    """Broker records: topic, key, value (the payload unchanged) and headers, after the columns of ``keep``.

    ``headers``: map of name to values, kept in name order before the relay's own.
    """
    pair = lambda k, v: F.struct(k.alias("key"), F.encode(v, "UTF-8").alias("value"))
    none = F.array().cast("array<struct<key:string,value:binary>>")
    given = none
    if headers is not None:
        entries = F.array_sort(F.map_entries(headers))
        given = F.coalesce(F.flatten(F.transform(entries, lambda e: F.transform(e["value"], lambda v: pair(e["key"], v)))), none)
    own = [pair(F.lit(id_header), stable_id)]
    if expected_stream:
        own.append(pair(F.lit(stream_header), F.lit(expected_stream)))
    ttl = F.when(F.col("ttl_seconds").isNotNull(), F.array(pair(F.lit(ttl_header), F.concat(F.col("ttl_seconds").cast("string"), F.lit("s"))))).otherwise(none)
    return messages.select(*keep, F.col("subject").alias("topic"), stable_id.alias("key"), F.col("payload").alias("value"), F.concat(given, F.array(*own), ttl).alias("headers"))


def write_messages(envelopes: DataFrame, path: str, order: list[str], by: str = "commit", made: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Messages in commit order: range-dealt by ``order``, sorted inside each file.

    With ``by='subject'`` only the messages of one topic keep that order: they
    lie in one file, and nothing is sampled to find ranges.  ``made`` turns rows
    that have the order's columns (and ``topic``) into envelopes when they lie in
    their files: what is sampled and moved is then as small as the rows are.
    """
    if by not in ("commit", "subject"):
        raise ValueError("messages are ordered by commit or by subject")
    if by == "subject":
        dealt = envelopes.repartition("topic").sortWithinPartitions("topic", *order)
    else:
        dealt = envelopes.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    (dealt if made is None else made(dealt)).write.mode("overwrite").parquet(path)


def manifest_of(spark: SparkSession, path: str, seq: int) -> DataFrame:
    """(seq, file, source_id, first, last, n): what message files hold; first and last commit as (file number, position)."""
    at = F.struct(F.coalesce(file_number(F.col("log_file")), F.lit(0)).alias("file_no"), F.col("commit_pos").alias("pos"))
    read = spark.read.schema(schemas.ENVELOPE).parquet(path).select("source_id", at.alias("at"), F.col("_metadata.file_path").alias("file"))
    return read.groupBy("file", "source_id").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n")).select(F.lit(seq).cast("long").alias("seq"), "file", "source_id", "first", "last", "n")


def read_manifest(spark: SparkSession, base: str) -> DataFrame | None:
    """The manifests that the state's pointer names, as one table; None if nothing was published."""
    found = read_pointer(spark, base)
    paths = [f"{base}/{v}/manifest" for v in (found or {}).get("manifests", [])]
    return spark.read.parquet(*paths) if paths else None


def read_messages(spark: SparkSession, base: str) -> DataFrame:
    """Messages of exactly the files that the manifest names.

    Files of a pass or batch that was not completed are not among them.  Sorted
    by a source's (seq, first) the files are in commit order, and so are the rows in each.
    """
    named = read_manifest(spark, base)
    files = [] if named is None else sorted(r["file"] for r in named.select("file").distinct().collect())
    return spark.read.schema(schemas.ENVELOPE).parquet(*files) if files else spark.createDataFrame([], schemas.ENVELOPE)


def _pointer(spark: SparkSession, base: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def swap_pointer(spark: SparkSession, base: str, content: dict) -> None:
    """Readers see the old content or the new, nothing between."""
    fs, root = _pointer(spark, base)
    jvm = spark._jvm
    fresh, current = (jvm.org.apache.hadoop.fs.Path(root, n) for n in (f"CURRENT.{uuid.uuid4().hex}", "CURRENT"))
    out = fs.create(fresh, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    options = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = jvm.java.lang.Enum.valueOf(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), "OVERWRITE")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, current, options)


def read_pointer(spark: SparkSession, base: str) -> dict | None:
    """What the pointer names, if there is one: version, snapshot, and the deltas on top of it in order."""
    fs, root = _pointer(spark, base)
    path = spark._jvm.org.apache.hadoop.fs.Path(root, "CURRENT")
    return json.loads(spark.read.text(path.toString()).first()[0]) if fs.exists(path) else None


def current_version(spark: SparkSession, base: str) -> str | None:
    """The version the pointer names, if any."""
    found = read_pointer(spark, base)
    return found and found["version"]


def _after(spark: SparkSession, base: str, **changes) -> dict:
    """The pointer's content with some of it changed."""
    before = read_pointer(spark, base) or {"version": None, "snapshot": None, "deltas": [], "done": {}, "side": {}, "manifests": [], "count": 0}
    return before | changes | {"count": before["count"] + 1}


def write_state(outbox: DataFrame, checkpoints: DataFrame, base: str, version: str | None = None) -> str:
    """Results and checkpoint as one unit: both tables first, one small pointer last.

    A reader follows the pointer, so it sees both or neither.  Writing a version
    again replaces it, which makes a repeated batch harmless.
    """
    version = version or uuid.uuid4().hex
    _written({"outbox": outbox, "checkpoints": checkpoints}, f"{base}/{version}")
    spark = outbox.sparkSession
    swap_pointer(spark, base, _after(spark, base, version=version, snapshot=version, deltas=[]))
    return version


def write_delta(changes: DataFrame, checkpoints: DataFrame, base: str, version: str, kind: str | None = None, side: dict[str, DataFrame] | None = None, manifest: DataFrame | None = None) -> None:
    """A change of the state as one unit: rows as they are now (or ``gone``), and the checkpoints.

    Nothing that stays is written again; ``compact`` folds deltas into a table.
    ``kind``: the line of work this version is the last of (see ``is_done``).
    ``side``: other tables to lie beside them; the last of a name is found by
    ``read_side``.  ``manifest``: of the messages that become visible with it.
    """
    spark = changes.sparkSession
    tables = {"changes": changes, "checkpoints": checkpoints} | (side or {}) | ({"manifest": manifest} if manifest is not None else {})
    _written(tables, f"{base}/{version}")
    now = _after(spark, base, version=version)
    now["deltas"], now["side"] = [*now["deltas"], version], now["side"] | dict.fromkeys(side or {}, version)
    now["done"] = now["done"] | ({kind: version} if kind else {})
    now["manifests"] = [*now["manifests"], *([version] if manifest is not None else [])]
    swap_pointer(spark, base, now)


def is_done(spark: SparkSession, base: str, kind: str, version: str) -> bool:
    """Whether a version of this line of work, whose names rise, is part of the state already."""
    return ((read_pointer(spark, base) or {}).get("done", {}).get(kind) or "") >= version


def read_side(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The table of this name that was written last beside a delta."""
    version = (read_pointer(spark, base) or {}).get("side", {}).get(name)
    return spark.read.parquet(f"{base}/{version}/{name}") if version else None


def row_keys(df: DataFrame) -> list[str]:
    """What names a row: its id, with its source where the table holds several."""
    return [c for c in ("source_id", "id") if c in df.columns]


def read_state(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame] | None:
    """(outbox, checkpoints) as the pointer names them; of a row's changes the last one counts."""
    found = read_pointer(spark, base)
    if found is None:
        return None
    checkpoints = spark.read.parquet(f"{base}/{found['version']}/checkpoints")
    changes = [spark.read.parquet(f"{base}/{v}/changes").withColumn("_seq", F.lit(k)) for k, v in enumerate(found["deltas"])]
    if not changes:
        return spark.read.parquet(f"{base}/{found['snapshot']}/outbox"), checkpoints
    rows = reduce(DataFrame.unionByName, changes)
    whole = spark.read.parquet(f"{base}/{found['snapshot']}/outbox") if found["snapshot"] else rows.drop("gone", "_seq").limit(0)
    keys = row_keys(whole)
    touched = rows.groupBy(*keys).agg(F.max("_seq").alias("_seq"))
    now = rows.join(touched, [*keys, "_seq"], "left_semi").where("not gone")
    return whole.join(touched, keys, "left_anti").unionByName(now.select(*whole.columns)), checkpoints


def compact(spark: SparkSession, base: str) -> None:
    """Folds deltas and manifests into one table each; what only the pointer before the last named goes with the next call."""
    found = read_pointer(spark, base)
    if found is None or not found["deltas"]:
        return
    version = f"{found['version']}{WHOLE}"
    outbox, checkpoints = read_state(spark, base)
    tables = {"outbox": outbox, "checkpoints": checkpoints} | ({"manifest": read_manifest(spark, base).coalesce(1)} if found["manifests"] else {})
    _written(tables, f"{base}/{version}")
    swap_pointer(spark, base, _after(spark, base, version=version, snapshot=version, deltas=[], manifests=[version] if found["manifests"] else []))
    prune(spark, base, keep=_named(found))


def _named(found: dict) -> list:
    return [found["version"], found["snapshot"], *found["deltas"], *found["side"].values(), *found["manifests"]]


def prune(spark: SparkSession, base: str, keep: list | None = None) -> list[str]:
    """Removes versions that neither the pointer nor ``keep`` names; returns their names.

    Readers of the state before may still be at work, so ``compact`` keeps it.
    """
    found = read_pointer(spark, base)
    if found is None:
        return []
    named = {*_named(found), *(keep or []), MESSAGES, PLANS}
    fs, root = _pointer(spark, base)
    gone = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName() not in named]
    for path in gone:
        fs.delete(path, True)
    return sorted(p.getName() for p in gone)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; in the warehouse only where the session names none."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A name of a new folder there.  The first one of a session removes what sessions before the last day left."""
    base = shared_dir(spark)
    if base not in _SWEPT:
        _SWEPT.add(base)
        sweep(spark, base, 86_400, STAGED)
    return f"{base}/{STAGED}{name}-{uuid.uuid4().hex}"


_SWEPT: set[str] = set()


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def spending(spark: SparkSession):
    """While it lasts a query's shuffles are removed as it ends, not when the driver happens to collect its garbage: for steps that are written and read back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def together(*jobs: Callable) -> list:
    """Runs small jobs that don't wait for each other side by side; the first error is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(job)) for job in jobs]]


def _written(tables: dict[str, DataFrame], folder: str) -> None:
    together(*(lambda name=name, df=df: df.write.mode("overwrite").parquet(f"{folder}/{name}") for name, df in tables.items()))


def exists(spark: SparkSession, path: str) -> bool:
    fs, root = _pointer(spark, path)
    return fs.exists(root)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that nothing reads any more."""
    fs, root = _pointer(spark, path)
    fs.delete(root, True)


def sweep(spark: SparkSession, base: str, older_than_seconds: int, prefix: str = "") -> list[str]:
    """Removes folders under ``base``, of names that begin with ``prefix``, that nothing has written to for so long: what finished runs have left staged."""
    fs, root = _pointer(spark, base)
    if not fs.exists(root):
        return []
    limit = time.time() * 1000 - older_than_seconds * 1000
    gone = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getModificationTime() <= limit and s.getPath().getName().startswith(prefix)]
    for path in gone:
        fs.delete(path, True)
    return sorted(p.getName() for p in gone)
