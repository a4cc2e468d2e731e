"""Views kept as Parquet folders that grow by batch and are merged when read.

    <view>/live/run=R/batch_id=N/[day=D/]    a batch, put in place whole by one rename
    <view>/base/version=V/[day=D/]           batches that a compaction has merged
    <view>/snapshots/<number>                names the folders of the base, and the folded batches

`run` names one checkpoint: batch numbers restart with a new checkpoint, and a new run name keeps
them apart. A batch that is there already, or has been folded into the base, is not written again, so
a replay changes nothing, also in the event log, whose rows are not merged. Numbers rise within a
run, so the ledger of folded batches is one number per run.

A view whose key has no time may be kept in hash buckets instead: a batch then rewrites the buckets
that it has keys of, merged with what they held, and publishes them. Reading merges nothing. This is
for views that are looked up more than they are written, with batches of few keys beside the buckets.

    <view>/base/version=V/bucket=B/          one row per key

A compaction rewrites only the days that its batches have rows of, and then publishes a snapshot.
Folders that are no longer named go one compaction later. A reader takes the folders of one snapshot
and the batches beside it, so it neither misses nor repeats a row while streams write and
compactions run.
"""

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from pagetide import snapshots
from pagetide.functions.timing import in_window
from pagetide.operators.views import PARTIALS, STORES, merge, project, spec_of, with_day
from pagetide.schemas import ddl
from pagetide.session import delete_folder, folders, move_folder

# Columns that lookups ask for by value; compacted files get Bloom filters on them.
LOOKUP_KEYS = ("user_id", "page_id", "domain")


def _folder(root, spec):
    return f"{root.rstrip('/')}/{spec.name}"


def _columns(spec):
    """Stored columns, with `day` left to the folder names."""
    return [name for name in spec.stored if name != "day"]


def _filters(writer, names):
    """Bloom filters on some columns, of the size that the number of values asks for."""
    for name in names:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true")


def _save(rows, path, spec, bloom=()):
    writer = rows.write.partitionBy("day") if spec.keyed_by_time else rows.write
    _filters(writer, bloom).parquet(path)


def _batch(run, batch_id):
    return f"run={run}/batch_id={batch_id}"


def _is_folded(content, run, batch_id):
    return bool(content) and batch_id <= content["folded"].get(run, -1)


def _write_view(events, root, run, batch_id, view):
    spec = spec_of(view)
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"a run is named by letters, digits, points and hyphens, not {run!r}")
    spark, folder = events.sparkSession, _folder(root, spec)
    place = f"{folder}/live/{_batch(run, batch_id)}"
    _, content = snapshots.current(spark, folder)
    if _bucketed(content):
        raise ValueError(f"{spec.name} is kept in buckets")
    if _is_folded(content, run, batch_id) or folders(spark, place):
        return
    rows = merge(project(events, spec), spec)
    if spec.keyed_by_time:
        # Few files per day, and a day with most of the rows is spread over several tasks.
        rows = with_day(rows).hint("rebalance", "day")
    new = f"{folder}/.new-{uuid.uuid4().hex}"
    _save(rows, new, spec)
    if not move_folder(spark, new, place):
        delete_folder(spark, new)


def _bucket(spec, count):
    """The whole key decides, so that a hot first column is spread."""
    return F.pmod(F.xxhash64(*spec.key), F.lit(count)).cast("int")


def _upsert(events, root, run, batch_id, spec, count):
    """Put the rows of a batch in the place of those with their keys, bucket by bucket."""
    spark, folder = events.sparkSession, _folder(root, spec)
    number, content = snapshots.current(spark, folder)
    if _is_folded(content, run, batch_id):
        return
    named = dict(content["buckets"]) if content else {}
    count = content["count"] if content else count
    rows = merge(project(events, spec), spec).withColumn("bucket", _bucket(spec, count))
    # At most as many numbers as there are buckets.
    touched = {str(row.bucket) for row in rows.select("bucket").distinct().collect()}
    held = [f"{folder}/base/{named[bucket]}" for bucket in sorted(touched & set(named))]
    rows = rows.drop("bucket")
    if held:
        rows = rows.unionByName(_rows(spark, spec, folder, [], held))
    rows = merge(rows, spec).withColumn("bucket", _bucket(spec, count))
    version = f"version={number + 1}-{uuid.uuid4().hex[:8]}"
    # Few files per bucket, also where one is far larger than a task should write.
    rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *spec.key)
    writer = rows.write.partitionBy("bucket")
    _filters(writer, [c for c in LOOKUP_KEYS if c in spec.columns]).parquet(f"{folder}/base/{version}")
    gone = []
    for path in folders(spark, f"{folder}/base/{version}/bucket=*"):
        bucket = path.rsplit("bucket=", 1)[1]
        if bucket in named:
            gone.append(f"base/{named[bucket]}")
        named[bucket] = "/".join(path.split("/")[-2:])
    folded = dict(content["folded"]) if content else {}
    folded[run] = batch_id
    left = snapshots.retired(spark, folder, content, gone)
    new = {"buckets": named, "count": count, "folded": folded, "retired": left}
    snapshots.publish(spark, folder, number + 1, new)


def in_buckets(view):
    """Whether a view can be kept in buckets: one row per key, and no time in it."""
    spec = spec_of(view)
    return not spec.keyed_by_time and not spec.mask


def write_batch(events, root, run, batch_id, views=None, buckets=None):
    """Merge one batch into each view. Writing the same batch again changes nothing.

    With `buckets`, a number, views whose key has no time are kept in so many buckets. A view keeps
    the form that its first batch gave it.

    The first view is written alone, so that a cached batch is complete before the other views are
    written side by side. Small views would otherwise keep a large cluster waiting one by one.
    """
    first, *others = views or STORES

    def write_one(view):
        if buckets and in_buckets(view):
            _upsert(events, root, run, batch_id, spec_of(view), buckets)
        else:
            _write_view(events, root, run, batch_id, view)

    write_one(first)
    if not others:
        return
    with ThreadPoolExecutor(len(others)) as pool:
        write = inheritable_thread_target(events.sparkSession)(write_one)
        started = [pool.submit(write, view) for view in others]
    for job in started:
        job.result()


def _live(spark, folder, content):
    """Folders of the batches that are not in the base, by run and number."""
    found = {}
    for path in folders(spark, f"{folder}/live/run=*/batch_id=*"):
        run, number = re.search(r"run=([^/]*)/batch_id=(\d+)$", path).groups()
        if not _is_folded(content, run, int(number)):
            found[run, int(number)] = path
    return found


def _rows(spark, spec, folder, live, base):
    """Stored rows of the named folders, not merged. Folders of no view are an error, as in Spark."""
    days = ", day date" if spec.keyed_by_time else ""
    reader = spark.read.schema(ddl(_columns(spec)) + days)
    parts = [
        reader.option("basePath", f"{folder}/{place}").parquet(*paths)
        for place, paths in (("live", live), ("base", base))
        if paths
    ] or [reader.parquet(folder)]
    # The names of runs and versions are no columns of the view.
    parts = [part.select(*_columns(spec), *(["day"] if days else [])) for part in parts]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _bucketed(content):
    return bool(content) and "buckets" in content


def _day_of(path):
    return path.rsplit("day=", 1)[-1]


def _base(folder, content, days=None):
    """Folders of the base, those of some days only if asked for. Days are text that sorts."""
    if _bucketed(content):
        return [f"{folder}/base/{name}" for name in content["buckets"].values()]
    names = content["base"] if content else []
    if days is not None:
        names = [name for name in names if days(_day_of(name))]
    return [f"{folder}/base/{name}" for name in names]


def scan(spark, root, view, bounds=None, days=None):
    """Stored rows of a view, not merged.

    `bounds` prunes day folders and filters `time`; `days`, a list of dates, prunes alone.
    """
    spec = spec_of(view)
    folder = _folder(root, spec)
    if (bounds or days is not None) and not spec.keyed_by_time:
        raise ValueError(f"{spec.name} has no time in its key: a time filter would be wrong")
    # The snapshot first: what it names stays while a compaction publishes the next one.
    _, content = snapshots.current(spark, folder)
    if _bucketed(content):
        return _rows(spark, spec, folder, [], _base(folder, content))
    live = list(_live(spark, folder, content).values())
    if bounds is None and days is None:
        return _rows(spark, spec, folder, live, _base(folder, content))
    if days is not None:
        base = _base(folder, content, set(map(str, days)).__contains__)
        wanted = F.col("day").isin([F.lit(day) for day in days])
    else:
        first, last = map(str, bounds.days)
        base = _base(folder, content, lambda day: first <= day <= last)
        wanted = F.col("day").between(*map(F.lit, bounds.days))
    if content and not live and not base:
        # Nothing of these days; a folder of others gives the columns.
        base = _base(folder, content)[:1]
    rows = _rows(spark, spec, folder, live, base).filter(wanted)
    if bounds is None:
        return rows
    column = next((name for name in ("time", "minute") if name in spec.columns), None)
    return in_window(rows, bounds, column) if column else rows


def read(spark, root, view, bounds=None, days=None):
    """Current rows of a view, one per key; of the event log, every event."""
    spec = spec_of(view)
    rows = scan(spark, root, spec, bounds, days)
    _, content = snapshots.current(spark, _folder(root, spec))
    # Buckets hold one row per key.
    rows = rows if _bucketed(content) else merge(rows, spec)
    return rows.select(*spec.columns)


def compact(spark, root, views=None):
    """Fold the batches that are there now into the base, one row per key, sorted by key.

    Run it regularly, one at a time: every batch adds a folder. Readers and streams go on meanwhile;
    a query that is still running when the second compaction after its start ends has to be started
    again. Range partitioning by the whole key spreads a hot first column over many files and gives
    each file a narrow key range, so key lookups skip most files, and Bloom filters skip others.
    """
    for view in views or _present(spark, root):
        _compact(spark, root, spec_of(view))


def _present(spark, root):
    """The stores, and the partial aggregates that are kept beside them."""
    there = {path.rsplit("/", 1)[-1] for path in folders(spark, f"{root.rstrip('/')}/*")}
    return [name for name in (*STORES, *PARTIALS) if name in there]


def _compact(spark, root, spec):
    folder = _folder(root, spec)
    number, content = snapshots.current(spark, folder)
    if _bucketed(content):
        return
    live = _live(spark, folder, content)
    named = content["base"] if content else []
    if live:
        named = named + _fold(spark, folder, spec, number, content, live)
    _clean(spark, folder, content, named)


def _fold(spark, folder, spec, number, content, live):
    """Write a new base for what the batches touch, and publish it. Names its folders."""
    base, kept = _base(folder, content), []
    if spec.keyed_by_time:
        days = {
            _day_of(path)
            for path in folders(spark, f"{folder}/live/run=*/batch_id=*/day=*")
            if path.rsplit("/", 1)[0] in live.values()
        }
        kept = [name for name in content["base"] if _day_of(name) not in days] if content else []
        base = _base(folder, content, days.__contains__)
    rows = merge(_rows(spark, spec, folder, list(live.values()), base), spec)
    if spec.is_log:
        rows, order = with_day(rows), ["day", "time", "seq"]
    elif spec.keyed_by_time:
        rows, order = with_day(rows), ["day", *[name for name in spec.key if name != "day"]]
    else:
        order = list(spec.key)
    version = f"version={number + 1}-{uuid.uuid4().hex[:8]}"
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    _save(rows, f"{folder}/base/{version}", spec, [c for c in LOOKUP_KEYS if c in spec.columns])
    made = [version]
    if spec.keyed_by_time:
        written = folders(spark, f"{folder}/base/{version}/day=*")
        made = [f"{version}/day={_day_of(path)}" for path in written]
    folded = dict(content["folded"]) if content else {}
    for run, batch_id in live:
        folded[run] = max(folded.get(run, -1), batch_id)
    snapshots.publish(spark, folder, number + 1, {"base": kept + made, "folded": folded})
    return kept + made


def _clean(spark, folder, content, named):
    """Remove what neither the snapshot before nor the one now names."""
    if not content:
        return
    live = set(_live(spark, folder, content).values())
    for path in folders(spark, f"{folder}/live/run=*/batch_id=*"):
        if path not in live:
            delete_folder(spark, path)
    days = "/day=*" if named and "/day=" in named[0] else ""
    for path in folders(spark, f"{folder}/base/version=*{days}"):
        if path.split("/base/")[-1] not in named:
            delete_folder(spark, path)
