"""Archives whose entries are spread over tasks, against the extraction of one archive at once."""

import io
import random
import zipfile
import zlib

from millrace.operators import archive, unpack


def zipped(files, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in files:
            z.writestr(name, data)
    return out.getvalue()


def patched(data, at, value):
    return data[:at] + value + data[at + len(value) :]


def archives():
    r = random.Random(4)
    files = [("a/", b""), ("a/full.md", b"# T\n" * 50), ("b.bin", r.randbytes(3000)), ("empty", b"")]
    good = zipped(files)
    first = good.find(b"PK\x01\x02")
    second = good.find(b"PK\x01\x02", first + 4)
    third = good.find(b"PK\x01\x02", second + 4)
    return {
        "good": good,
        "stored": zipped(files, zipfile.ZIP_STORED),
        "crc of the second file": patched(good, third + 16, b"\0\0\0\0"),
        "size of the first file": patched(good, second + 24, b"\1\0\0\0"),
        "encrypted": patched(good, third + 8, b"\1\0"),
        "method": patched(good, third + 10, b"\x0c\0"),
        "cut": good[:-30],
        "no archive": b"text",
        "null": None,
        "unsafe": zipped([("ok", b"x"), ("../up", b"y")]),
        "two faults": patched(patched(good, third + 16, b"\0\0\0\0"), good.find(b"PK\x01\x02", third + 4) + 8, b"\1\0"),
        "bzip": zipped([("x", b"abc" * 99)], zipfile.ZIP_BZIP2),
        "nothing": zipped([]),
    }


def test_like_one_archive_at_once(spark):
    rows = archives()
    df = spark.createDataFrame([(k, v, 1) for k, v in rows.items()], "archive string, content binary, ordinal int")
    got = {}
    for x in unpack.extract_all(df, 5).collect():
        got.setdefault(x.archive, []).append((x.ordinal, x.name, x.size, x.crc, None if x.content is None else bytes(x.content), x.error))
    # One archive at once is refused for any entry's record before any content is looked at; here the first bad entry speaks for it.
    assert [(x[0], x[5]) for x in got.pop("two faults")] == [(2, "CORRUPT")]
    del rows["two faults"]
    for key, data in rows.items():
        try:
            expected = [(n, c) for n, c in archive.extract(data or b"")]
            assert [(x[1], x[4]) for x in sorted(got.get(key, []))] == expected, key
            assert all(x[3] == zlib.crc32(x[4]) and x[2] == len(x[4]) and x[5] is None for x in got.get(key, []))
        except (archive.ArchiveError, zlib.error) as e:
            assert [x[5] for x in got[key]] == [getattr(e, "code", "CORRUPT")], key
    assert got["unsafe"][0][0] == 1 and got["cut"][0][0] == -1


def test_caps_are_running_sums(spark):
    data = zipped([(f"f{k}", bytes(10 * (k + 1))) for k in range(5)])
    df = spark.createDataFrame([("z", data)], "archive string, content binary")
    bad = lambda **caps: [(x.ordinal, x.error) for x in unpack.extract_all(df, 3, **caps).collect() if x.error]
    assert bad(max_entries=4) == [(-1, "TOO_MANY")]
    assert bad(max_entry=35) == [(3, "TOO_LARGE")]
    assert bad(max_total=59) == [(2, "TOO_LARGE")]
    assert bad(max_total=150, max_entry=50, max_entries=5) == []


def test_packing_and_nothing(spark):
    df = spark.createDataFrame([(1, 2, "b", b"2"), (1, 1, "a", b"1"), (2, 1, "c", None)], "archive long, k int, name string, data binary")
    out = unpack.extract_all(unpack.packed(df, "archive", "k", "name", "data"), 2).collect()
    assert sorted((x.archive, x.ordinal, x.name, bytes(x.content)) for x in out) == [(1, 0, "a", b"1"), (1, 1, "b", b"2"), (2, 0, "c", b"")]
    assert unpack.extract_all(spark.createDataFrame([], "archive long, content binary"), 2).count() == 0
