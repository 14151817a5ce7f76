"""What goes to Python from crawls: heads, and records by slices."""

import pyarrow as pa

from spanloom.sources import formats


def test_records_are_parsed_by_slices():
    size = formats.SLICE // 3
    record = b"WARC-Type: response\r\nWARC-Target-URI: u\r\nContent-Length: %d\r\n\r\nH\r\n\r\n" % (size + 5) + b"x" * size
    batch = pa.RecordBatch.from_arrays([pa.array([record] * 20)], ["piece"])
    found = list(formats._warc_parsed(iter([batch])))
    assert max(b.nbytes for b in found) < 2 * formats.SLICE
    assert [x for b in found for x in b.column(2).to_pylist()] == ["x" * size] * 20


def test_pieces_stay_out_of_python(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"WARC/1.0\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    plan = formats._warc_pieces(spark, f"file://{tmp_path}")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan
