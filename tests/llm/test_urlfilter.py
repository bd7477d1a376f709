"""URL filters against a plain reading of the rules and of the list."""

from __future__ import annotations

import re

import numpy as np
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import difference, oracle_frame
from tideshift.llm import urlfilter
from tideshift.llm.corpus_queries import RULES

URLS = [
    None, "", "no scheme", "http://", "http://A.Example.COM/de/x?y#z", "http://example.com/de", "http://example.com/de/",
    "https://x.org/fr/1", "https://org/fr/", "https://xorg/fr/", "http://a.example.net/en/1", "http://net", "http://net/", "http://a.net?q/",
    "x://y://z/p", "http://bad.test/a", "http://sub.bad.test", "http://notbad.test/a", "http://other.test/exact", "http://other.test/exact/",
    "http://other.test/exact?x", "http://ÄB.test/ü", "http://" + "a." * 3000 + "bad.test/", "http://h/" + "p" * 100_000, "a\nb://q.org/fr/\n",
    "http://.bad.test./", "://bad.test/x",
]
LIST = ["bad.test", "other.test/exact", None, "", "bad.test", "ÄB.test", "Äb.test"]


def expected(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(r), r, v) for r, v in RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    labels = host.split(".")
    names = {".".join(labels[i:]) for i in range(len(labels))} | {host + path}
    listed = bool(host) and bool({n for n in names if n} & {e for e in LIST if e})
    rule = max(fits)[1] if fits else None
    return host, path, rule, listed, max(fits)[2] if fits else ("block" if listed else "allow")


@pytest.mark.parametrize("longest", [urlfilter.MAX_ENTRIES, 0])
def test_urls(spark, monkeypatch, longest):
    monkeypatch.setattr(urlfilter, "MAX_ENTRIES", longest)
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, "http://bad.test/", "h"), (4, URLS[4], "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    entries = spark.createDataFrame([(e,) for e in LIST], "entry string")
    got = [tuple(r) for r in urlfilter.judge(df, RULES, entries, keep=("page_id", "host")).collect()]
    assert sorted(got, key=str) == sorted([(i, *expected(u)) for i, u, _ in rows], key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    entries = spark.createDataFrame([], "entry string")
    assert urlfilter.judge(df, RULES, entries).count() == 0
    one = spark.createDataFrame([(1, "http://a.test/")], "page_id long, url string")
    assert urlfilter.judge(one, RULES, entries).collect()[0]["verdict"] == "allow"


def test_collisions_are_compared_in_full(tmp_path):
    file = tmp_path / "list"
    file.write_bytes(b"".join(urlfilter.DigestArray.pack([b"one", b"two", b"three"])))
    stored = urlfilter.DigestArray(str(file))
    assert stored.holds([b"one", b"four", b"three"]).tolist() == [True, False, True]
    # Another string under the digest of a stored one.
    assert stored.holds([b"else"], np.array([stored.keys[1]])).tolist() == [False]


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    ours = queries()["op2_urls"](spark, sf).toPandas()
    assert difference(ours, oracle_frame(oracle_sql()["op2_urls"], sf)) is None
    assert (ours[ours.rule.isna()].verdict == "block").any()
