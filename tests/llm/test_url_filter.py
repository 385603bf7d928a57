import numpy as np
from pyspark.sql import functions as F

from emberledger.llm import url_filter as U

URLS = [
    None, "", "no scheme", "http://EXAMPLE.net/en/1", "https://a.Example.NET/en/x?q#f", "http://example.net", "http://example.net/",
    "http://notexample.com/de/", "http://x.example.com/de/1", "http://example.com/de", "ftp://spam-farm.example.org/en", "http://q.org/fr/",
    "http://q.org/fr", "http://org/fr/x", "://host/p", "http://ads-track.example.com/en/?x", "http://", "http://h?a/b", "http://h#a/b", "http://a://b/c",
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if set(host.split(".")) & set(U.LISTED) else "allow"


def test_awkward_urls(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[:4])] + [(None, URLS[4], "x")], "page_id long, url string, rule string")
    for keys in (200_000, 3):  # one shard, or several
        got = U.judge(pages, shard_keys=keys).collect()
        assert len(got) == len(URLS) + 5
        for r in got:
            if r.page_id is not None:
                assert (r.host, r.path, r.rule, r.verdict) == plain((URLS + URLS[:4])[r.page_id]), r
    assert U.judge(pages.limit(0)).count() == 0


def test_cascade_is_exact():
    rng = np.random.default_rng(4)
    for n, share in ((1, 1.0), (1, 0.0), (5000, 0.01), (5000, 0.5), (5000, 0.99)):
        keys = rng.integers(0, 2**63, (n, 2)).astype("u8")
        listed = rng.random(n) < share
        levels = U.build_cascade(keys, listed)
        assert (U.test_cascade(levels, keys) == listed).all()
        if n > 1 and share == 0.01:
            assert sum(len(d) for _, _, d in levels) < 200 * 8


def test_groups_of_shards_beyond_the_broadcast_bound(spark):
    keys = spark.range(3000).select(F.concat(F.lit("h"), "id").alias("host"))
    built = U.cascades(keys, "host", F.col("host").endswith("7"), shard_keys=200)
    assert built.count() > 10
    got = U.with_listed(keys, "host", built, limit=500)
    assert got.filter("listed <> endswith(host, '7')").count() == 0 and got.count() == 3000
