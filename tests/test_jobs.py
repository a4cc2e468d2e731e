"""The submitted jobs end to end over landed event frames."""

import json
from pathlib import Path

import pytest
from helpers import envelope

from pagetide.__main__ import main
from pagetide.operators import documents
from pagetide.schemas import REPORT_ROWS
from pagetide.streaming import jobs


def lines(folder):
    return [
        json.loads(line)
        for path in sorted(Path(folder).glob("part-*"))
        for line in path.read_text().splitlines()
    ]


def test_frames_to_reports_and_lookups(spark, tmp_path):
    at = str(tmp_path) + "/"
    (tmp_path / "feed").mkdir()
    frames = [
        f"event: message\nid: {i}\ndata: "
        + envelope(f"2024-01-16T0{5 + i % 3}:00:0{i}Z", page_id=i, page_title=f"p{i}")
        for i in range(6)
    ] + ["event: message\ndata: broken", ":keep-alive"]
    (tmp_path / "feed" / "1.sse").write_text("\n\n".join(frames) + "\n\n")

    main(["normalize", "--input", at + "feed", "--frames", "--out", at + "wire",
          "--checkpoint", at + "c1", "--once"])
    main(["normalize", "--input", at + "feed", "--frames", "--out", at + "once",
          "--checkpoint", at + "c0", "--once", "--redelivered", "1 hour"])
    assert jobs.normalized_files(spark, at + "once", streaming=False).count() == 6
    main(["views", "--input", at + "wire", "--root", at + "views", "--run", "r1",
          "--quarantine", at + "aside", "--checkpoint", at + "c2", "--once", "--partials"])
    (tmp_path / "keys").write_text("3\n99\nnot a number\n")
    root = "views"
    for compacted in (False, True):
        if compacted:
            main(["compact", "--root", at + "views"])
        main(["reports", "--root", at + root, "--out", at + "out", "--as-of",
              "2024-01-16 12:30:00"])
        folder = Path(documents.report_path(spark, at + "out", "hourly_domain_page_stats"))
        document = json.loads("".join(p.read_text() for p in sorted(folder.glob("part-*"))))
        assert [bucket["time_start"] for bucket in document] == ["05:00", "06:00", "07:00"]
        assert [bucket["statistics"] for bucket in document] == [[{"a.org": 2}]] * 3

        main(["lookup", "pages-by-user", "5", "--root", at + root, "--out", at + "l1"])
        assert [row["page_id"] for row in lines(at + "l1")] == list(range(6))
        main(["lookup", "domain-page-count", "a.org", "no", "--root", at + root, "--out", at + "l2"])
        assert {row["domain"]: row["page_count"] for row in lines(at + "l2")} == {"a.org": 6, "no": 0}
        main(["lookup", "page-details", "3", "--root", at + root, "--out", at + "l3"])
        assert lines(at + "l3")[0]["time"] == "2024-01-16T05:00:03.000Z"
        main(["lookup", "domains", "--root", at + root, "--out", at + "l4"])
        assert lines(at + "l4") == [{"domain": "a.org"}]
        main(["lookup", "active-days", "2024-01-16", "2024-01-17", "--root", at + root,
              "--out", at + "l5"])
        assert lines(at + "l5") == [{"user_id": 5, "username": "five", "page_count": 1}]
        main(["lookup", "pages-created", "2024-01-16", "2024-01-16", "--root", at + root,
              "--out", at + "l6"])
        assert lines(at + "l6") == [{"user_id": 5, "username": "five", "pages_created": 6}]
        main(["lookup", "page-details", "--keys-file", at + "keys", "--root", at + root,
              "--out", at + "l7"])
        assert sorted(row["page_id"] for row in lines(at + "l7")) == [3, 99]
        for name in REPORT_ROWS:
            main(["read", name, "--reports", at + "out", "--out", at + "read"])
            before = sorted(map(json.dumps, lines(at + "read")))
            main(["reports", "--root", at + root, "--out", at + "partial", "--as-of",
                  "2024-01-16 12:30:00", "--partials"])
            main(["read", name, "--reports", at + "partial", "--out", at + "read"])
            assert before and sorted(map(json.dumps, lines(at + "read"))) == before
        main(["reports", "--root", at + root, "--out", at + "events", "--as-of",
              "2024-01-16 12:30:00", "--grain", "event"])
        found = documents.read_report(spark, at + "events", "hourly_domain_page_stats")
        assert [row.pages_created for row in found.collect()] == [2, 2, 2]

    with pytest.raises(SystemExit):
        main(["hourly", "--input", at + "wire", "--out", at + "hours", "--checkpoint", at + "c3"])
    main(["hourly", "--quarantine", at + "bad",  "--input", at + "wire", "--out", at + "hours", "--checkpoint", at + "c3",
          "--once", "--max-files", "1"])
    rows = spark.read.parquet(at + "hours").collect()
    assert [(row.domain, row.pages_created) for row in rows] == [("a.org", 2)]
    main(["hourly", "--quarantine", at + "bad2", "--input", at + "wire", "--out", at + "right",
          "--checkpoint", at + "c4", "--once", "--root", at + "minutes", "--run", "r1"])
    assert [row.pages_created for row in jobs.corrected_hours(spark, at + "right").collect()] == [2] * 3
