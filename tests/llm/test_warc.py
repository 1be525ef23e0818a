import hashlib
import io
import random
import zipfile
import zlib

import pytest

from ledgerline.llm import warc as W
from ledgerline.llm.runtime import shared_folder


def pages(spark):
    r = random.Random(3)
    big = "é" * 60  # 120 bytes, 60 characters
    rows = [(i, f"http://x/{i}?a=1&b=é%20\r\n", "<p>" + "w" * r.randint(0, 300) + "</p>", "z") for i in range(30)]
    rows += [(50, None, big, "z"), (40, "u", big, "z"), (41, "u", big, "z"), (40, "u", big, "z"), (None, "u", big, "z"), (60, "u", "short", "z"), (61, "u", "short", "z"),
             (62, "u", None, "z"), (63, "u", "", "z"), (None, "u", "only without an id " * 9, "z"), (None, "u", "only without an id " * 9, "z"), (70, "u", "x" * 400_000, "z")]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def expected(rows):
    first = {}
    for i, _, h, _ in rows:
        data = (h or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(first.get(data, i), i)
    count = {}
    for _, _, h, _ in rows:
        count[(h or "").encode()] = count.get((h or "").encode(), 0) + 1
    out = []
    for i, u, h, _ in rows:
        data = (h or "").encode()
        f = first.get(data) if count[data] > 1 else None
        revisit = f is not None and i != f
        out.append((i, u, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return out


def test_round_trip(spark):
    rows, df = pages(spark)
    folder = shared_folder(spark, "test-warc")
    manifest = W.write_archives(spark, df.repartition(3), folder, archive_bytes=2000)
    assert sum(r["records"] for r in manifest.collect()) == len(rows) and manifest.count() > 3
    got = W.read_archives(spark, manifest, chunk_bytes=700).collect()
    fields = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=repr) == sorted(expected(rows), key=repr)
    for r in got:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        assert r["payload"] is None or hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]


def test_empty_table(spark):
    _, df = pages(spark)
    manifest = W.write_archives(spark, df.limit(0), shared_folder(spark, "test-warc"))
    assert manifest.count() == 0 and W.read_archives(spark, manifest).count() == 0


def archive(records, comment=b"", **kw):
    buf, index, at = io.BytesIO(), [], 0
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED, **kw) as z:
        with z.open(W.DATA, "w", force_zip64=True) as m:
            for k, data in enumerate(records):
                c = zlib.compressobj(1, zlib.DEFLATED, 31)
                packed = c.compress(data) + c.flush()
                m.write(packed)
                index.append(f'k{k} t {{"offset": {at}, "length": {len(packed)}}}')
                at += len(packed)
        z.writestr(W.INDEX, "\n".join(index))
        z.writestr("notes.txt", b"packed " * 100, zipfile.ZIP_DEFLATED)
        z.comment = comment
    return buf.getvalue()


def test_directories_of_zip_and_zip64():
    data = [W.record(k, "u", b"p" * k, hashlib.sha256(b"p" * k).hexdigest(), None, False) for k in range(20)]
    plain = archive(data, comment=b"a comment")
    members = W.stored_members(io.BytesIO(plain), len(plain))
    assert set(members) == {W.DATA, W.INDEX}  # the packed member is not readable by range
    with zipfile.ZipFile(io.BytesIO(plain)) as z:
        for name, (at, n) in members.items():
            assert plain[at:at + n] == z.read(name)
    # A ZIP64 end record: written by hand from the same directory.
    import struct
    end = plain.rfind(b"PK\x05\x06")
    count, size, at = struct.unpack("<HII", plain[end + 10:end + 20])
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, size, at)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, end, 1)
    wide = plain[:end] + end64 + locator + b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    assert W.stored_members(io.BytesIO(wide), len(wide)) == members
    # A central entry whose sizes and offset stand in its ZIP64 field.
    name = W.INDEX.encode()
    p = wide.find(b"PK\x01\x02")
    while wide[p + 46:p + 46 + len(name)] != name:
        p = wide.find(b"PK\x01\x02", p + 4)
    assert struct.unpack("<H", wide[p + 30:p + 32])[0] == 0
    packed, full, local = *struct.unpack("<II", wide[p + 20:p + 28]), struct.unpack("<I", wide[p + 42:p + 46])[0]
    extra = struct.pack("<HHQQQ", 1, 24, full, packed, local)
    entry = bytearray(wide[p:p + 46])
    entry[20:28], entry[42:46], entry[30:32] = b"\xff" * 8, b"\xff" * 4, struct.pack("<H", len(extra))
    moved = wide[:p] + bytes(entry) + name + extra + wide[p + 46 + len(name):]
    shift = len(extra)
    q = moved.rfind(b"PK\x06\x06")
    moved = moved[:q + 40] + struct.pack("<QQ", size + shift, at) + moved[q + 56:]
    q = moved.rfind(b"PK\x06\x07")
    moved = moved[:q + 8] + struct.pack("<Q", end + shift) + moved[q + 16:]
    assert W.stored_members(io.BytesIO(moved), len(moved)) == members
    assert sum(len(c[2]) for c in W.chunks(io.BytesIO(plain), len(plain), 300)) == 20


@pytest.mark.parametrize("damage", [lambda b: b[:-30], lambda b: b"", lambda b: b"no zip" * 50, lambda b: b.replace(b"PK\x01\x02", b"PKxx")])
def test_damaged_archives_are_refused(damage):
    bad = damage(archive([b"x"]))
    with pytest.raises(ValueError):
        W.stored_members(io.BytesIO(bad), len(bad))


def test_a_damaged_payload_is_refused():
    data = W.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False)
    assert W.parse_record(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        W.parse_record(data.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))
