import re

import numpy as np
from pyspark.sql import functions as F

from cadence.llm import url_filter

URLS = [
    None, "", "no scheme", "http://a.com", "http://a.com/", "HTTPS://WWW.Example.COM/en/x?y#z", "https://example.com/en/",
    "https://sub.example.com/en", "https://sub.example.com/en/1", "http://net/es/1", "http://x.net/fr/?a", "http://x.net/de/2",
    "http://badexample.com/en/", "http://notnet/es/", "x://Ünet/es/", "a://b://c.net/es/", "http://h.net?x=/es/", "://com/",
    "http://x.org/en/a\nb", "http://x.net/es/1", "http://x.net/es/1",
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r, _ in url_filter.RULES for d, _, b in [r.partition("/")]
            if (host == d or host.endswith("." + d)) and path.startswith("/" + b)]
    return host, path, max(fits, key=len, default=None)


def test_rules_and_parts_equal_a_plain_version(spark):
    rows = [(i, u, "html", "clash") for i, u in enumerate(URLS)] + [(None, URLS[4], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = url_filter.url_report(pages).collect()
    assert len(out) == len(rows)
    for r in out:
        url = URLS[4] if r["page_id"] is None else URLS[r["page_id"]]
        host, path, rule = plain(url)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        if rule:
            assert r["verdict"] == dict(url_filter.RULES)[rule]
        assert r["verdict"] in ("allow", "block")
    assert url_filter.url_report(pages.limit(0)).collect() == []


def test_model_learns_from_a_labelled_table(spark):
    labelled = spark.createDataFrame(
        [(f"{k}{i}.test", f"/{p}/{i}", v) for i in range(60) for k, p, v in (("casino", "win", "block"), ("school", "read", "allow"))],
        "host string, path string, verdict string")
    model = url_filter.fit(labelled)
    scores = model.scores(["casinox.test", "myschool.test"], ["/win/1", "/read/2"])
    assert scores[0] > 0.9 and scores[1] < 0.1
    assert url_filter.fit(labelled.limit(0)).scores(["x"], ["/"])[0] < 0.5


def test_held_out_rule_verdicts(spark):
    """URLs that the training did not see, judged by the model alone."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = url_filter.judged(pages).where("rule is not null")
    labelled = rows.withColumn("verdict", url_filter.verdict_of(F.col("rule"))).withColumn(
        "fold", F.crc32(F.encode(F.concat_ws("|", "host", "path"), "utf-8")) % 4)
    model = url_filter.fit(labelled.where("fold <> 2"), 400)
    held = labelled.where("fold = 2").select("host", "path", "verdict").distinct().collect()
    scores = model.scores([r["host"] for r in held], [r["path"] for r in held])
    right = sum((s >= 0.5) == (r["verdict"] == "block") for s, r in zip(scores, held))
    assert len(held) > 100 and right / len(held) > 0.95


def test_verdicts_where_no_rule_fits_equal_a_plain_score(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = url_filter.judged(pages)
    model = url_filter.fit(rows.where("rule is not null").withColumn("verdict", url_filter.verdict_of(F.col("rule"))))

    def plain_score(host, path):
        grams = []
        for salt, text in ((1, host), (2, path)):
            raw = b"\x02" + text.encode() + b"\x03"
            for n in url_filter.GRAMS:
                for i in range(len(raw) - n + 1):
                    h = (salt << 8) + n
                    for byte in raw[i:i + n]:
                        h = (h * 0x100000001B3 & 2**64 - 1) ^ byte
                    grams.append(int(url_filter.mixed(np.array([h], np.uint64))[0]) >> 64 - url_filter.BITS)
        z = sum(model.weights[g] for g in grams) / max(len(grams), 1) ** 0.5 + model.intercept
        return 1 / (1 + np.exp(-z))

    out = [r for r in url_filter.url_report(pages).collect() if r["rule"] is None]
    assert out
    for r in out:
        score = plain_score(r["host"], r["path"])
        assert abs(score - r["block_score"]) < 1e-9
        assert r["verdict"] == ("block" if score >= 0.5 else "allow")
