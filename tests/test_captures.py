import io
import os
import pickle
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from backdrop.sources import captures as CAP
from backdrop.streaming import jobs as J

END = 0xFFFFFFFF


def session_capture(records, announced=None, end_after=False):
    """Writer side of the session framing (tests build their own captures)."""
    out = [struct.pack("!I", len(records) if announced is None else announced)]
    for name, frame_id, payload in records:
        raw = name if isinstance(name, bytes) else name.encode("utf-8")
        out += [struct.pack("!I", len(raw)), raw, struct.pack("!II", frame_id, len(payload)), payload]
    if end_after:
        out += [struct.pack("!I", 3), b"end", struct.pack("!II", END, 0)]
    return b"".join(out)


def bare_capture(payloads, terminate=True):
    out = [struct.pack("!I", len(p)) + p for p in payloads]
    if terminate:
        out.append(struct.pack("!I", 0))
    return b"".join(out)


RECS = [("cam_0.jpg", 0, b"\x01\x02\x03"), ("cam_1.jpg", 1, b"abcd"), ("cam_2.jpg", 2, b"xyz")]


def frames(rows):
    return [r for r in rows if r["seq"] is not None]


def trailer(rows):
    t = [r for r in rows if r["seq"] is None]
    assert len(t) == 1
    return t[0]


def test_complete_capture():
    rows = list(CAP.decode_session_capture(session_capture(RECS), "c"))
    got = [(r["filename"], r["frame_id"], r["payload"]) for r in frames(rows)]
    assert got == RECS
    assert [r["seq"] for r in frames(rows)] == [0, 1, 2]
    assert all(r["announced"] == 3 and r["status"] == "success" for r in frames(rows))
    assert not trailer(rows)["truncated"]


def test_zero_frames_is_empty():
    rows = list(CAP.decode_session_capture(struct.pack("!I", 0), "c"))
    assert frames(rows) == [] and trailer(rows)["announced"] == 0


def test_announced_more_than_sent_is_truncated():
    rows = list(CAP.decode_session_capture(session_capture(RECS, announced=5), "c"))
    assert len(frames(rows)) == 3 and trailer(rows)["truncated"]


def test_announced_less_than_sent_stops_at_count():
    rows = list(CAP.decode_session_capture(session_capture(RECS, announced=2), "c"))
    assert [r["frame_id"] for r in frames(rows)] == [0, 1] and not trailer(rows)["truncated"]


def test_end_marker_stops_without_reading_payload():
    data = session_capture(RECS[:2], announced=3, end_after=True)
    rows = list(CAP.decode_session_capture(data, "c"))
    assert [r["frame_id"] for r in frames(rows)] == [0, 1]
    assert trailer(rows)["message"].startswith("end marker")


def test_zero_size_payload_and_names():
    recs = [("é.jpg", 7, b""), (b"\xff\xfe.jpg", 8, b"ok"), ("日本.png", 9, b"p")]
    rows = frames(list(CAP.decode_session_capture(session_capture(recs), "c")))
    assert rows[0]["status"] == "unreadable" and rows[0]["filename"] == "é.jpg"
    assert rows[1]["status"] == "error" and "file name" in rows[1]["message"]
    assert rows[2]["status"] == "success" and rows[2]["filename"] == "日本.png"


def test_every_cut_point_keeps_only_complete_records():
    data = session_capture(RECS)
    ends, pos = [], 4
    for name, _, payload in RECS:
        pos += 4 + len(name.encode()) + 8 + len(payload)
        ends.append(pos)
    for cut in range(len(data) + 1):
        rows = list(CAP.decode_session_capture(data[:cut], "c"))
        complete = sum(1 for e in ends if e <= cut)
        assert len(frames(rows)) == complete, cut
        assert trailer(rows)["truncated"] == (cut < len(data)), cut


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=20), max_size=6), st.data())
def test_bare_framing_any_cut(payloads, data):
    blob = bare_capture(payloads)
    cut = data.draw(st.integers(0, len(blob)))
    rows = list(CAP.decode_bare_capture(blob[:cut], "c"))
    got = [r["payload"] for r in frames(rows)]
    assert got == payloads[:len(got)]
    if cut == len(blob):
        assert got == payloads and trailer(rows)["message"].startswith("complete")


def test_bare_size_zero_ends_stream():
    rows = list(CAP.decode_bare_capture(bare_capture([b"a"]) + bare_capture([b"zz"]), "c"))
    assert [r["payload"] for r in frames(rows)] == [b"a"]


@pytest.fixture()
def capture_dir(tmp):
    d = os.path.join(tmp, "captures")
    os.makedirs(d)
    with open(os.path.join(d, "s1.bin"), "wb") as fh:
        fh.write(session_capture(RECS))
    with open(os.path.join(d, "s2.bin"), "wb") as fh:
        fh.write(session_capture(RECS, announced=4)[:-2])  # cut inside the last payload
    with open(os.path.join(d, "live.raw"), "wb") as fh:
        fh.write(bare_capture([b"a", b"bb"]))
    return d


def test_spark_binaryfile_reader(spark, capture_dir):
    recs = CAP.read_captures(spark, capture_dir, "session")
    done = {r["capture"].rsplit("/", 1)[-1]: r for r in CAP.capture_completeness(recs).collect()}
    assert (done["s1.bin"]["announced"], done["s1.bin"]["received"], done["s1.bin"]["complete"]) == (3, 3, True)
    assert (done["s2.bin"]["announced"], done["s2.bin"]["received"], done["s2.bin"]["truncated"]) == (4, 2, True)
    got = sorted(CAP.frames_of(recs).select("filename", "frame_id").collect())
    assert len(got) == 5
    bare = CAP.read_captures(spark, capture_dir, "bare")
    assert sorted(r["payload"] for r in CAP.frames_of(bare).collect()) == [b"a", b"bb"]


def test_python_data_source_matches_binaryfile(spark, capture_dir):
    CAP.register_capture_source(spark)
    ds = CAP.read_capture_files(spark, capture_dir, "session")
    bf = CAP.read_captures(spark, capture_dir, "session")
    cols = ["capture", "seq", "filename", "frame_id", "payload", "announced", "truncated", "status"]
    norm = lambda df: sorted((repr(tuple(r)) for r in df.select(*cols).withColumn(
        "capture", F.regexp_replace("capture", "^file:", "")).collect()))
    assert norm(ds) == norm(bf)


def everything(framing, blob, most=1 << 20):
    """Rows by ranges of at most ``most`` bytes, as :func:`decode_session_capture` gives them."""
    src = io.BytesIO(blob)
    parts = list(CAP.find_ranges(src, len(blob), framing, "c", "c", most=most))
    assert [p.message is None for p in parts] == [True] * (len(parts) - 1) + [False]
    return [row for p in parts for row in CAP.decode_range(src, p, framing)]


def test_ranges_decode_like_whole_captures(monkeypatch):
    odd = [("é.jpg", 7, b""), (b"\xff\xfe.jpg", 8, b"ok"), *RECS]
    for blob in (session_capture(odd), session_capture(RECS, announced=2), session_capture(RECS[:2], announced=3, end_after=True), struct.pack("!I", 0)):
        for cut in range(len(blob) + 1):
            for most in (1, 40, 1 << 20):
                assert everything("session", blob[:cut], most) == list(CAP.decode_session_capture(blob[:cut], "c"))
    blob = bare_capture([b"a", b"bcd" * 9, b"e"]) + b"more"
    monkeypatch.setattr(CAP, "HEADER_FETCH", 5)
    for cut in range(len(blob) + 1):
        assert everything("bare", blob[:cut], 8) == list(CAP.decode_bare_capture(blob[:cut], "c"))


def test_header_pass_seeks_past_payloads():
    class Counted(io.BytesIO):
        got = 0

        def read(self, n=-1):
            data = super().read(n)
            self.got += len(data)
            return data

    blob = session_capture([(f"{i}", i, bytes(1 << 20)) for i in range(20)])
    src = Counted(blob)
    parts = list(CAP.find_ranges(src, len(blob), "session", "c", "c", most=4 << 20))
    assert len(parts) == 8 and src.got < 25 * CAP.HEADER_FETCH


def test_a_long_capture_is_decoded_by_several_tasks(spark, tmp):
    frames_ = [(f"f{i}.jpg", i, os.urandom(300)) for i in range(10_000)]
    with open(os.path.join(tmp, "long.bin"), "wb") as fh:
        fh.write(session_capture(frames_))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        records = CAP.read_captures(spark, tmp, range_bytes=100_000).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    got = sorted((r["seq"], r["filename"], r["frame_id"], r["payload"]) for r in records if r["seq"] is not None)
    assert got == [(i, n, k, p) for i, (n, k, p) in enumerate(frames_)]
    assert len({r["task"] for r in records}) >= 6


def test_a_capture_over_two_gib(spark, tmp):
    """A payload too long for a value is an error row; records behind it, over 2 GiB into the file, are read."""
    huge = (1 << 31) + 5
    with open(os.path.join(tmp, "huge.bin"), "wb") as fh:
        fh.write(struct.pack("!I", 3) + struct.pack("!I", 1) + b"a" + struct.pack("!II", 0, huge))
        fh.seek(huge, os.SEEK_CUR)  # a hole: no disk is used
        for name, frame_id, payload in RECS[:2]:
            fh.write(struct.pack("!I", len(name)) + name.encode() + struct.pack("!II", frame_id, len(payload)) + payload)
    rows = {r["seq"]: r for r in CAP.read_captures(spark, tmp).collect()}
    assert rows[0]["status"] == "error" and rows[0]["payload"] is None and str(huge) in rows[0]["message"]
    assert [rows[i]["payload"] for i in (1, 2)] == [p for _, _, p in RECS[:2]] and rows[None]["message"] == "complete; 3 frames"


def test_growing_captures_are_read_once(spark, tmp):
    """Appended to between the runs of a query, cut inside records, with a bound on a trigger's bytes or without."""
    blobs = {"a.bin": session_capture([(f"a{i}", i, bytes([i]) * 50) for i in range(20)]),
             "b.bin": session_capture(RECS[:2], announced=9, end_after=True), "c.bin": session_capture(RECS, announced=5)}
    for bound in (None, 200):
        folder, out, ck = (os.path.join(tmp, f"{x}{bound}") for x in ("in", "out", "ck"))
        os.makedirs(folder)
        for share in (0.0, 0.13, 0.5, 0.5, 0.77, 1.0, 1.0):
            for name, blob in blobs.items():
                with open(os.path.join(folder, name), "wb") as fh:
                    fh.write(blob[: int(len(blob) * share)])
            query = J.write_stream(CAP.follow_captures(spark, folder, bytes_per_trigger=bound), out, ck, partition_by=None)
            J.drain(query)
        rows = spark.read.parquet(out).collect()
        for name, blob in blobs.items():
            got = sorted((tuple(r)[1:] for r in rows if r["capture"].endswith(name)), key=repr)
            want = [tuple(r.values())[1:] for r in CAP.decode_session_capture(blob, "c") if not r["truncated"]]
            assert [x for x in got if x[0] is not None] == sorted((x for x in want if x[0] is not None), key=repr)
            ends = [x for x in got if x[0] is None]
            # c.bin stops before its announced count, so it may go on.
            assert ends == [x for x in want if x[0] is None]


def test_bare_capture_cut_inside_a_size_prefix():
    data = struct.pack("!I", 3) + b"abc"
    for cut in range(0, 4):
        for src in (data + struct.pack("!I", 9)[:cut], io.BytesIO(data + struct.pack("!I", 9)[:cut])):
            last = list(CAP.decode_bare_capture(src, "c"))[-1]
            assert last["truncated"] == (cut > 0)


def test_a_stream_reads_headers_once_for_offset_and_plan(tmp, monkeypatch):
    blobs = {"a.bin": session_capture([(f"a{i}", i, bytes([i]) * 50) for i in range(20)]), "b.bin": session_capture(RECS, announced=9)}
    opened = []
    monkeypatch.setattr(CAP.storage, "open_file", lambda uri, whole=CAP.storage.open_file: opened.append(uri) or whole(uri))
    monkeypatch.setattr(CAP, "RANGE_BYTES", 100)

    def planned(reader, start, end):
        return [part for split in reader.partitions(start, end) for part in split.parts]

    reader, start = CAP._CaptureStreamReader({"path": tmp}), {}
    for share in (0.4, 0.6, 1.0):
        for name, blob in blobs.items():
            with open(os.path.join(tmp, name), "wb") as fh:
                fh.write(blob[: int(len(blob) * share)])
        opened.clear()
        end = reader.latestOffset()
        parts = planned(reader, start, end)
        assert len(opened) == len(blobs)
        # A reader that has found nothing itself plans the same records.
        anew = planned(CAP._CaptureStreamReader({"path": tmp}), start, end)
        rows = [[tuple(r.values()) for r in CAP._decode_ranges(p, "session")] for p in (parts, anew)]
        assert rows[0] == rows[1] and rows[0]
        start = end
    assert not reader.found


def grown(folder, blobs, share):
    os.makedirs(folder, exist_ok=True)
    for name, blob in blobs.items():
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(blob[: int(len(blob) * share)])


def records(rows):
    return sorted((os.path.basename(r["capture"]), r["seq"], r["payload"], r["message"]) for r in rows if r["seq"] is not None)


def whole(blobs):
    return records({**r, "capture": name} for name, blob in blobs.items() for r in CAP.decode_session_capture(blob, name))


def test_growing_captures_are_not_held_by_the_driver(spark, tmp):
    """Neither offsets nor the tasks' partitions name the captures that a stream follows."""
    sizes = []
    for n in (3, 300):
        blobs = {f"{i}.bin": session_capture(RECS[: 1 + i % 3]) for i in range(n)}
        folder, out, ck = (os.path.join(tmp, f"{x}{n}") for x in ("in", "out", "ck"))
        for share in (0.6, 1.0):
            grown(folder, blobs, share)
            with J.state_partitions(spark, 2):
                query = J.write_stream(CAP.follow_captures(spark, folder), out, ck, partition_by=None)
            J.drain(query)
        assert records(spark.read.parquet(out).collect()) == whole(blobs)
        sizes.append([os.path.getsize(os.path.join(ck, "offsets", b)) for b in ("0", "1")])
    assert sizes[0] == sizes[1]
    reader = CAP._ListingStreamReader({"path": os.path.join(tmp, "in300"), "listings": os.path.join(tmp, "listings")})
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len(pickle.dumps(parts)) < 300 * 40 and sum(b.num_rows for p in parts for b in reader.read(p)) == 300


def test_growing_captures_of_a_batch_that_is_run_again(spark, tmp):
    """A restart repeats the last micro-batch, which a sink may have or not, after the captures have grown."""
    blobs = {f"{i}.bin": session_capture([(f"{i}-{k}", k, bytes([i, k]) * 20) for k in range(9)]) for i in range(4)}
    folder = os.path.join(tmp, "in")
    for sink in ("files", "batches"):
        out, ck = os.path.join(tmp, f"out-{sink}"), os.path.join(tmp, f"ck-{sink}")
        for run, share in enumerate((0.3, 0.6, 1.0, 1.0)):
            grown(folder, blobs, share)
            if run == 2:  # which runs that micro-batch and no other
                for name in ("1", ".1.crc"):
                    os.remove(os.path.join(ck, "commits", name))
            with J.state_partitions(spark, 2):
                recs = CAP.follow_captures(spark, folder)
                query = J.write_stream(recs, out, ck, partition_by=None) if sink == "files" else J.write_batches(recs, out, ck)
            J.drain(query)
        assert records(spark.read.parquet(out).collect()) == whole(blobs)


def test_growing_captures_while_a_query_runs(spark, tmp):
    blobs = {f"{i}.bin": session_capture([(f"{i}-{k}", k, bytes([i, k]) * 20) for k in range(9)]) for i in range(4)}
    for bound in (None, 300):
        folder, out, ck = (os.path.join(tmp, f"{x}{bound}") for x in ("in", "out", "ck"))
        grown(folder, blobs, 0.2)
        with J.state_partitions(spark, 2):
            query = J.write_stream(CAP.follow_captures(spark, folder, bytes_per_trigger=bound), out, ck, "100 milliseconds", None)
        try:
            for share in (0.5, 0.5, 1.0):
                grown(folder, blobs, share)
                query.processAllAvailable()
        finally:
            query.stop()
        assert records(spark.read.parquet(out).collect()) == whole(blobs)


def test_listings_hold_what_grew_up_to_the_bound(tmp):
    folder, at = os.path.join(tmp, "in"), {}
    reader = CAP._ListingStreamReader({"path": folder, "listings": os.path.join(tmp, "listings"), "bytesPerTrigger": "25"})
    blobs = {f"{i}.bin": bytes(10 * i) for i in range(5)}
    start = reader.initialOffset()
    assert start == {} and reader.latestOffset() == {}
    for share, steps in ((0.5, 2), (1.0, 2), (1.0, 0)):
        grown(folder, blobs, share)
        for _ in range(steps):
            end = reader.latestOffset()
            new = {os.path.basename(r["uri"]): r["size"] for p in reader.partitions(start, end) for b in reader.read(p) for r in b.to_pylist()}
            assert sum(size - at.get(name, 0) for name, size in new.items()) == 25
            at |= new
            reader.commit(end)
            start = end
        assert reader.latestOffset() == start and {n: int(len(b) * share) for n, b in blobs.items()} == at
    assert reader.partitions(start, start) == [] and len(os.listdir(reader.folder)) == 1


def test_scan_finds_what_walk_finds(tmp):
    for name in ("a", "b/c", "b/d/e.bin", "f/g"):
        os.makedirs(os.path.dirname(os.path.join(tmp, name)), exist_ok=True)
        with open(os.path.join(tmp, name), "wb") as fh:
            fh.write(name.encode())
    for uri in (tmp, f"file:{tmp}", f"file://{tmp}", f"{tmp}/missing"):
        assert sorted(CAP.storage.scan(uri)) == sorted(CAP.storage.walk(uri))
