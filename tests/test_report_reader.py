"""Published documents read back: the same rows, and errors for whatever was changed in them."""

import shutil

import pytest
from helpers import event, events_frame, tuples
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pagetide.functions.timing import report_bounds
from pagetide.operators import documents
from pagetide.operators.report_reader import read_document
from pagetide.schemas import BOT_REPORT, HOURLY_REPORT, REPORT_ROWS, TOP_USERS_REPORT

BOUNDS = report_bounds("2024-01-16 12:30:00")
ODD = ['d"{}.org', "{}\\n.org", "{}é.org", "{}  \r.org", '{}":[', "],{}", "[{}", ",{}"]


def rows_of(n=400):
    return [
        event(
            f"2024-01-16 0{5 + i % 4}:{i % 7:02d}:{i % 60:02d}",
            domain=ODD[i % 8].format(f"{i % 40:03d}"),
            user_id=i % 9,
            username=None if i % 9 == 3 else ODD[i % 9 % 8].format(i % 9),
            created_by_bot=i % 2 == 0,
            page_title=None if i % 9 == 4 else ODD[i % 8].format(i % 20),
            seq=i,
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def original(spark, tmp_path_factory):
    """All reports, each over several files."""
    out, frame = tmp_path_factory.mktemp("reports"), events_frame(spark, rows_of())
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    documents.publish(spark, frame, frame, BOUNDS, str(out))
    spark.conf.set(key, before)
    return out


@pytest.fixture
def published(original, tmp_path):
    shutil.copytree(original, tmp_path, dirs_exist_ok=True)
    return tmp_path


@pytest.fixture
def blocks(spark):
    """Reads files in blocks of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(key) for key in keys]
    yield lambda size: [spark.conf.set(key, size) for key in keys]
    for key, value in zip(keys, before):
        spark.conf.set(key, value)


def parts(out, name):
    return sorted(out.glob(f"{name}/version-*/document/part-*"))


@pytest.mark.parametrize("block", ["128m", "300b"])
@pytest.mark.parametrize("name", list(REPORT_ROWS))
def test_document_and_rows_agree(spark, published, blocks, name, block):
    """Also where tasks start in the middle of a file."""
    assert len(parts(published, name)) > 1
    blocks(block)
    found = read_document(spark, str(published), name)
    want = documents.read_report(spark, str(published), name)
    if name == TOP_USERS_REPORT:
        # A document lists titles that are known; a user without any has one row.
        known = want.filter("page_title is not null")
        without = want.join(known, "user_id", "left_anti").distinct()
        want = known.union(without.select(*known.columns))
        assert without.count() == 1
    assert tuples(found, *want.columns) == tuples(want)


def lines_of(path):
    return path.read_text().split("\n")[:-1]


def entries(lines):
    return [at for at, line in enumerate(lines) if not line.startswith(("[", "]"))]


def changed(out, name, change):
    """A change to the lines of the part file with the most of them."""
    path = max(parts(out, name), key=lambda one: len(lines_of(one)))
    lines = change(lines_of(path))
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    path.write_text("".join(f"{line}\n" for line in lines))


def edit(lines, old, new):
    at = next(at for at in entries(lines) if old in lines[at])
    return [*lines[:at], lines[at].replace(old, new, 1), *lines[at + 1 :]]


def swapped(lines):
    at = next(a for a, b in zip(entries(lines), entries(lines)[1:]) if lines[a] < lines[b] and a + 1 == b)
    return [*lines[:at], lines[at + 1], lines[at], *lines[at + 2 :]]


def without(kind):
    def change(lines):
        at = next(at for at, line in enumerate(lines) if kind in line)
        return [*lines[:at], *lines[at + 1 :]]

    return change


def without_comma(lines):
    at = next(at for at in entries(lines) if lines[at].startswith(","))
    return [*lines[:at], lines[at][1:], *lines[at + 1 :]]


CHANGES = {
    "comma": without_comma,
    "swapped": swapped,
    "twice": lambda lines: [*lines[:5], lines[4].lstrip(","), *lines[5:]],
    "space": lambda lines: edit(lines, ":", ": ") if '":' in "".join(lines) else [" ", *lines],
    "cut line": lambda lines: [*lines[:-1], lines[-1][:-1]],
    "blank": lambda lines: [*lines[:3], "", *lines[3:]],
    "junk": lambda lines: [*lines, ",null"],
}


@pytest.mark.parametrize("change", list(CHANGES))
@pytest.mark.parametrize("name", list(REPORT_ROWS))
def test_changed_documents_are_errors(spark, published, name, change):
    changed(published, name, CHANGES[change])
    with pytest.raises(ValueError, match="document"):
        read_document(spark, str(published), name)


@pytest.mark.parametrize("kind", ["time_start", "]}", '],"pages_created"'])
def test_a_missing_head_or_tail_is_an_error(spark, published, kind):
    for name in (TOP_USERS_REPORT,) if "pages" in kind else (HOURLY_REPORT,):
        for path in parts(published, name):
            if any(kind in line for line in lines_of(path)):
                path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
                path.write_text("".join(f"{line}\n" for line in without(kind)(lines_of(path))))
                break
        with pytest.raises(ValueError, match="document"):
            read_document(spark, str(published), name)


@pytest.mark.parametrize("name", list(REPORT_ROWS))
def test_a_missing_part_is_an_error(spark, published, name):
    for path in (parts(published, name)[0], parts(published, name)[-1]):
        kept = path.read_text()
        path.rename(path.with_suffix(".away"))
        (path.parent / f"_{path.with_suffix('.away').name}").write_text(kept)
        path.with_suffix(".away").unlink()
        with pytest.raises(ValueError, match="document"):
            read_document(spark, str(published), name)
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
        path.write_text(kept)
    assert read_document(spark, str(published), name).count()


def test_empty_and_missing_documents(spark, tmp_path):
    frame = events_frame(spark, [event("2020-01-01 00:00:00")])
    documents.publish(spark, frame, frame, BOUNDS, str(tmp_path))
    for name in REPORT_ROWS:
        assert read_document(spark, str(tmp_path), name).collect() == []
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_document(spark, str(tmp_path / "none"), HOURLY_REPORT)


def test_lines_are_read_by_many_tasks(spark, published):
    """No report passes through one task: only rows of blocks are summed without a key."""
    rows = read_document(spark, str(published), BOT_REPORT)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(part" in plan
    assert rows.filter(F.col("created_by_bots") > 0).count() == rows.count()
