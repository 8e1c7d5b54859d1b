"""Archives as a round trip, and what the reader saves from damaged ones."""

import base64
import gzip
import hashlib
import random
import re
from collections import defaultdict

import pyarrow as pa

from codeweft.llm import warc

PAYLOADS = [(f"page {k} " * (50 * k + 1)).encode() for k in range(6)]
RECORDS = [warc.record(k, f"http://x/{k}", p, None, False) for k, p in enumerate(PAYLOADS)]
MEMBERS = [warc.member(r) for r in RECORDS]


def read(data):
    found = list(warc.salvage(data))
    good = [f.fields["warc-record-id"] for f in found if f.fields]
    return [int(name[10:-1]) for name in good], [(f.begin, f.end) for f in found if not f.fields]


def test_whole_archives():
    assert read(b"".join(MEMBERS)) == (list(range(6)), [])
    assert read(b"\0\0".join(MEMBERS)) == (list(range(6)), [])
    assert read(b"".join(RECORDS)) == (list(range(6)), [])
    assert read(b"") == ([], [])
    assert gzip.decompress(b"".join(MEMBERS)) == b"".join(RECORDS)


def test_every_damaged_byte_costs_its_own_record_at_most():
    ends = [sum(map(len, MEMBERS[: k + 1])) for k in range(6)]
    data = b"".join(MEMBERS)
    for at in range(0, len(data), 7):
        hurt = bytearray(data)
        hurt[at] ^= 0x55
        k = next(i for i, end in enumerate(ends) if at < end)
        good, gaps = read(bytes(hurt))
        assert good in (list(range(6)), [i for i in range(6) if i != k])
        if k not in good:
            assert gaps == [(ends[k] - len(MEMBERS[k]), ends[k])]


def test_truncation_garbage_and_plain_records():
    whole = sum(map(len, MEMBERS[:3]))
    data = b"".join(MEMBERS[:3]) + MEMBERS[3][:40]
    assert read(data) == ([0, 1, 2], [(whole, len(data))])
    assert read(b"junk" + MEMBERS[0] + b"WARC/1.1\r\nbad" + MEMBERS[1]) == ([0, 1], [(0, 4), (4 + len(MEMBERS[0]), 4 + len(MEMBERS[0]) + 13)])
    wrong = RECORDS[1].replace(b"page 1 page 1", b"page 1 page X", 1)
    good, gaps = read(RECORDS[0] + wrong + RECORDS[2])
    assert good == [0, 2] and gaps == [(len(RECORDS[0]), len(RECORDS[0]) + len(wrong))]


def plain(rows, least=0):
    groups = defaultdict(list)
    for i, html in rows:
        groups[(html or "").encode()].append(i)
    out = []
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        top = max((i for i in ids if i is not None), default=None)
        for i in ids:
            again = len(ids) > 1 and i != top and len(payload) >= least
            out.append(str((i, len(payload), digest, "revisit" if again else "response", top if again else None)))
    return sorted(out)


ROWS = [(k, f"<p>{k % 7}é</p>" * (k % 5)) for k in range(60)] + [
    (100, None), (101, ""), (102, "x\r\n\r\nWARC/1.1\r\ny"), (103, "z" * 20_000_000), (104, "\0" * 9), (105, "same"), (105, "same"), (None, "same"), (-3, "same")
]


def test_round_trip(llm):
    pages = llm.createDataFrame([(i, None if i == 100 else f"http://h/{i}\r\nX: y", h) for i, h in ROWS], "page_id bigint, url string, html string")
    for least in (0, 10):
        got = warc.round_trip(pages, least).collect()
        assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == plain(ROWS, least)
    assert warc.round_trip(pages.where("false")).count() == 0


def test_gaps_are_rows(llm, tmp_path):
    hurt = bytearray(b"".join(MEMBERS))
    hurt[len(MEMBERS[0]) + 20] ^= 1
    (tmp_path / "a.warc.gz").write_bytes(bytes(hurt))
    rows = warc.read_archives(llm, str(tmp_path), with_payload=True).collect()
    assert sorted(r.page_id for r in rows if r.reason is None) == [0, 2, 3, 4, 5]
    assert [(r.begin, r.end) for r in rows if r.reason] == [(len(MEMBERS[0]), len(MEMBERS[0]) + len(MEMBERS[1]))]
    assert all(r.payload == PAYLOADS[r.page_id] for r in rows if r.reason is None)


def test_many_records_in_one_member():
    wrong = RECORDS[2].replace(b"page 2 page 2", b"page 2 page X", 1)
    data = warc.member(b"".join([*RECORDS[:2], wrong, *RECORDS[3:]]))
    assert read(data) == ([0, 1, 3, 4, 5], [(0, len(data))])
    gap = next(f for f in warc.salvage(data) if not f.fields)
    begin = len(RECORDS[0] + RECORDS[1])
    assert gap.reason.endswith(f"unpacked bytes {begin} to {begin + len(wrong)}")
    assert read(data + MEMBERS[0])[0] == [0, 1, 3, 4, 5, 0]
    short = warc.member(RECORDS[0] + RECORDS[1].replace(b"Content-Length: ", b"Content-Length: 9", 1) + RECORDS[2])
    assert read(short)[0] == [0, 2]


def test_damaged_and_cut_members_keep_their_whole_records():
    rng = random.Random(3)
    records = [warc.record(k, "http://x", rng.randbytes(5000), None, False) for k in range(40)]
    data = warc.member(b"".join(records))
    for cut in (len(data) // 2, len(data) - 4):
        good, gaps = read(data[:cut])
        assert good == list(range(len(good))) and len(good) >= 40 * cut // len(data) - 1
        assert len(gaps) == 1 and gaps[0][1] == cut and 0 < gaps[0][0] < cut
    hurt = bytearray(data)
    hurt[-6] ^= 1  # the CRC
    assert read(bytes(hurt))[0] == list(range(40))
    assert read(bytes(hurt) + MEMBERS[5])[0] == [*range(40), 5]
    hurt = bytearray(data)
    hurt[len(data) // 2] ^= 1  # one byte of a stored block
    good, gaps = read(bytes(hurt))
    assert len(good) == 39 and gaps
    plain = [re.sub(rb"WARC-(Block|Payload)-Digest: [^\r]*\r\n", b"", r) for r in RECORDS]
    whole = warc.member(b"".join(plain))
    assert read(whole) == (list(range(6)), [])
    assert read(whole[:-6])[0] == list(range(6))
    hurt = bytearray(whole)
    hurt[-6] ^= 1  # nothing shows which of them are right
    assert read(bytes(hurt)) == ([], [(0, len(whole))])


def test_gaps_are_logged_in_a_table(llm, tmp_path):
    hurt = b"".join(MEMBERS[:2]) + b"junk" + b"".join(MEMBERS[2:])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(hurt)
    (tmp_path / "in" / "b.warc.gz").write_bytes(MEMBERS[0])
    assert warc.quarantine(warc.read_archives(llm, str(tmp_path / "in")), str(tmp_path / "gaps")) == 1
    row = llm.read.parquet(str(tmp_path / "gaps")).first()
    begin = len(MEMBERS[0] + MEMBERS[1])
    assert row.file.endswith("a.warc.gz") and (row.begin, row.end, row.bytes) == (begin, begin + 4, 4) and row.reason
    assert warc.quarantine(warc.read_archives(llm, str(tmp_path / "in" / "b.warc.gz")), str(tmp_path / "none")) == 0
    assert llm.read.parquet(str(tmp_path / "none")).count() == 0


def test_archives_end_at_a_number_of_bytes(monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1000)
    rng = random.Random(5)
    rows = [{"page_id": k, "url": None, "html": rng.randbytes(300).hex(), "first": None, "revisit": False} for k in range(20)]
    batches = [pa.RecordBatch.from_pylist(rows[k : k + 4]) for k in range(0, 20, 4)]
    sizes = defaultdict(list)
    for batch in warc._members(iter(batches)):
        for archive, member in zip(batch["archive"].to_pylist(), batch["member"].to_pylist(), strict=True):
            sizes[archive].append(len(member))
    assert len(sizes) > 5 and all(sum(s[:-1]) < 1000 for s in sizes.values()) and sum(map(len, sizes.values())) == 20
