import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import url_filter as U
from fleetlens.llm import warc as W

PAGES = "page_id long, url string, html string"


def pages():
    rng = random.Random(4)
    same = "ä" * 600
    rows = [(i, f"http://x.example.org/p q/{i}\n?a=1", "".join(rng.choice("abc<>é\x00\r\n") for _ in range(rng.randrange(4000)))) for i in range(60)]
    rows += [(100 + i, None, same) for i in range(5)] + [(104, "http://a/", same), (None, "http://n/", same)]
    rows += [(200 + i, "http://s/", "short") for i in range(3)] + [(300, "", None), (301, "x", ""), (None, None, None), (302, "u", "z" * 999), (303, "u", "z" * 999), (304, "big", "ß" * 3_000_000)]
    return rows


def brute(rows):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        top = max(ids, default=None)
        revisit = len(raw) >= 1000 and top is not None and i != top
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(llm):
    rows = pages()
    df = llm.createDataFrame(rows, PAGES).withColumns({"payload": F.lit(1), "same": F.lit(1), "target": F.lit(1), "path": F.lit(1)})
    assert sorted((tuple(r) for r in W.page_records(df.repartition(3)).collect()), key=repr) == brute(rows)
    assert W.page_records(llm.createDataFrame([], PAGES)).collect() == []


@pytest.mark.parametrize("step", [1, 700, 4096, 1 << 30])
def test_every_record_is_read_once_whatever_the_ranges(llm, step):
    files = W.write_warc(llm.createDataFrame(pages()[:12], PAGES).coalesce(1))
    path, size = files.first()[:2]
    if step == 1:  # every byte as a range of its own, over the start of the file
        got = [at for s in range(2500) for at, _ in W.read_range(path, s, s + 1)]
        assert got == [at for at, _ in W.read_range(path, 0, 2500)] and got[0] == 0
    else:
        got = [at for s in range(0, size, step) for at, _ in W.read_range(path, s, min(size, s + step))]
        assert len(got) == 12 == len(set(got))
        assert W.read_warc(files, step).count() == 12


def test_magic_inside_a_payload_is_no_record(tmp_path):
    """A payload that gzip stores as it is holds a whole archive."""
    import os
    import zlib

    inner = W.record("response", "urn:inner", "u", os.urandom(3000))
    rec = W.record("response", "urn:outer", "u", b"")
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    body = b"HTTP/1.1 200 OK\r\n\r\n" + inner + os.urandom(50) + W.MAGIC + os.urandom(500)
    outer = pack.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:big>\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n") + pack.flush()
    path = tmp_path / "x.warc.gz"
    path.write_bytes(rec + outer + rec)
    starts = [0, len(rec), len(rec) + len(outer)]
    size = path.stat().st_size
    for step in (64, 300, 5000):
        assert [at for s in range(0, size, step) for at, _ in W.read_range(str(path), s, min(size, s + step))] == starts


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
URLS = [
    None, "", "no scheme", "://", "http://", "http://ORG", "http://org/", "http://Example.ORG/es/x?y#z", "http://example.org/es", "https://a.b.example.org/en/12",
    "http://badexample.org/es/", "http://x.com/fr/", "http://x.com/de/1#f", "http://com?x/de/", "a://b://c/d", "http://l.net/x.html", "https://www.l.net:443/x/", "http://l.net/x?q", "http://m.net/x", "http://ÄB.net/É?",
]


def judge(url, listed):
    import re

    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [(len(r), a, r) for a, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    best = max(fits, default=(0, "block" if listed else "allow", None))
    return host, path, best[2], best[1], listed


@pytest.mark.parametrize("bits", [64 * 8, 1 << 20])
def test_rules_and_list(llm, bits):
    """A filter of one block lets nearly everything through; the join mends it."""
    rows = [(i, u) for i, u in enumerate(URLS)] * 2 + [(None, "http://l.net/x")]
    names = "name host path rule verdict listed maybe html".split()
    df = llm.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("clash") for c in names})
    block = llm.createDataFrame([("http://www.l.net/x//",), (None,), ("junk",), ("http://org/",)], "url string")
    got = U.judge_urls(df, block, RULES, most_bits=bits).collect()
    in_list = lambda u: u in ("http://l.net/x.html", "https://www.l.net:443/x/", "http://l.net/x?q", "http://l.net/x", "http://org/", "http://ORG")
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((i, *judge(u, in_list(u))) for i, u in rows), key=repr)
    none = U.judge_urls(df, block.limit(0), RULES).collect()
    assert not any(r.listed for r in none) and len(none) == len(rows)
    assert U.judge_urls(df.limit(0), block, RULES).collect() == []
