import pytest

from spanloom.sources import formats


def record(uri, body, kind="response", size=None):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(body) if size is None else size}\r\n\r\n".encode() + body + b"\r\n\r\n"


def responses(spark, path):
    return sorted((r["uri"], r["body"]) for r in formats.warc_responses(spark, path).collect())


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", n)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("split", ["128m", "65536", "4096", "700"])
def test_records_over_split_ends(spark, tmp_path, small_splits, split):
    """Each body holds the mark of a record, and a whole record."""
    small_splits(split)
    want = []
    for f in range(2):
        data = b""
        for i in range(200 if split != "700" else 20):
            body = f"{i}-" * 300 + "WARC/1.0\r\nnot a record " + "y" * (i * 7 % 500) + record("inner", b"H\r\n\r\ninner").decode() + "end"
            data += record(f"info{i}", b"x" * i, "warcinfo") + record(f"u{f}-{i}", b"HTTP/1.1 200\r\n\r\n" + body.encode())
            want.append((f"u{f}-{i}", body))
        (tmp_path / f"{f}.warc").write_bytes(data)
    assert responses(spark, f"file://{tmp_path}") == sorted(want)
    assert formats.warc_errors(spark, f"file://{tmp_path}").count() == 0


def test_broken_records_leave_the_others(spark, tmp_path):
    good = [record(f"u{i}", b"H\r\n\r\nbody%d" % i) for i in range(4)]
    data = good[0] + record("bad", b"H\r\n\r\nx", size="many") + good[1] + b"WARC/1.0\r\nno end of head" + good[2] + record("long", b"H\r\n\r\nx", size=10**9) + good[3]
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "empty.warc").write_bytes(b"")
    assert responses(spark, f"file://{tmp_path}") == [(f"u{i}", f"body{i}") for i in range(4)]
    assert sorted(r["error"] for r in formats.warc_errors(spark, f"file://{tmp_path}").collect()) == ["no content length", "no end of the head", "the file ends within the record"]
