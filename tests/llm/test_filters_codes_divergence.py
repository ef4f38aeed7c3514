"""URL filters, vector codes and the divergence of sources against plain Python on small tables, odd rows included."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from registra.llm import divergence, url_filters, vector_codes

LABELS = ["a", "b", "ab", "net", "org", "com", ""]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def parts_of(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return lowered(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def judged(url, rules, default="allow"):
    host, path = parts_of(url)
    fit = []
    for rule, verdict in rules.items():
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fit.append((len(rule), len(h), rule, verdict))
    return host, path, *(max(fit)[2:] if fit else (None, default))


def a_host(rnd):
    return ".".join(rnd.choice(LABELS) for _ in range(rnd.randint(1, 4)))


def a_path(rnd):
    path = "".join(rnd.choice(["/", "/a", "/b", "/a/", "b", "é"]) for _ in range(rnd.randint(0, 4)))
    return path if path[:1] in ("", "/") else "/" + path


@pytest.mark.parametrize("ranges", [1, 23])
def test_url_filters(spark, ranges):
    rnd = random.Random(5)
    rules = {a_host(rnd) + a_path(rnd): rnd.choice(["allow", "block"]) for _ in range(300)}
    urls = [rnd.choice(["http://", "HTTPS://"]) + a_host(rnd) + a_path(rnd) + rnd.choice(["", "?x=http://", "#y/é"]) for _ in range(600)]
    # repeated and hot ones, long ones, none at all
    urls += [None, "", "abc", "a.net/b", "HTTP://A.NET", "x://u@A.b.NET:80/a/☃", *["http://net/"] * 500, "http://" + "a." * 3000 + "net/a" + "/b" * 9000]
    pages = spark.createDataFrame([(i, u, "k", "r", "d") for i, u in enumerate(urls)], "page_id long, url string, key string, row string, rule string")
    table = spark.createDataFrame(list(rules.items()), "rule string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in url_filters.judge(pages, table, ranges=ranges).collect()}
    assert got == {i: judged(u, rules) for i, u in enumerate(urls)}


def test_url_rules_at_the_edge(spark):
    urls = ["http://x.example.net/en/1", "http://example.net/e", "http://badexample.net/en/", "http://net", "http://org/fr/", "http://a.org/fr", None, None]
    pages = spark.createDataFrame([(None if i > 5 else i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rules = spark.createDataFrame([*url_filters.RULES, ("NET/", "allow"), (None, "block"), ("com/", None)], "rule string, verdict string")
    got = Counter((r.page_id, r.rule, r.verdict) for r in url_filters.judge(pages, rules, default="none").collect())
    assert got == Counter({
        (0, "example.net/en/", "allow"): 1, (1, "net/", "block"): 1, (2, "net/", "block"): 1, (3, None, "none"): 1, (4, "org/fr/", "allow"): 1, (5, None, "none"): 1, (None, None, "none"): 2,
    })
    assert url_filters.judge(pages, rules.limit(0)).where("verdict = 'allow' AND rule IS NULL").count() == len(urls)
    assert url_filters.judge(pages.limit(0), rules).count() == 0


def coded(rows, parts=16, entries=64, rounds=2):
    """{vec_id: (code, error, label_error)} and the digest, by plain integers."""
    kept = sorted(((i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in kept]
    width = len(whole[0]) // parts
    cut = [[v[width * j : width * (j + 1)] for j in range(parts)] for v in whole]
    books = [[v[j] for v in cut[:entries]] for j in range(parts)]

    def near(j, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[j]))

    for _ in range(rounds):
        for j in range(parts):
            members = defaultdict(list)
            for v in cut:
                members[near(j, v[j])[1]].append(v[j])
            books[j] = [[sum(c) // len(c) for c in zip(*members[i])] if i in members else e for i, e in enumerate(books[j])]
    found = [[near(j, v[j]) for j in range(parts)] for v in cut]
    errors, labels = [sum(d for d, _ in f) for f in found], Counter()
    for (_, _, label), e in zip(kept, errors):
        labels[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, "".join(f"{k:02x}" for _, k in f), e, labels[label], digest) for (i, _, label), f, e in zip(kept, found, errors))


@pytest.mark.parametrize("n", [7, 300])
def test_vector_codes(spark, n):
    rnd = random.Random(n)
    # few values, so that distances tie and entries repeat
    rows = [(rnd.choice([i, i, -i, 1 << 61]), [rnd.choice([-1.0, -0.3, 0.0, 0.25, 0.5, rnd.random()]) for _ in range(32)], rnd.choice([0, 1, None])) for i in range(n)]
    rows += [(1, rows[0][1], 0), (2, rows[0][1], None), (None, rows[1][1], 3), (None, rows[2][1], 3)]
    odd = [(5, None, 1), (6, [], 1), (7, [1.0] * 31 + [None], 1), (8, [float("nan")] * 32, 1), (9, [1.0] * 31 + [float("inf")], 1)]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows + odd], "vec_id long, embedding array<double>, label int, code string, v string")
    assert Counter(map(tuple, vector_codes.codes(table.repartition(3)).collect())) == coded(rows)
    assert vector_codes.codes(spark.createDataFrame(odd, "vec_id long, embedding array<double>, label int")).count() == 0
    other = spark.createDataFrame([(1, [1.0] * 16, 1), (2, [0.5] * 16, 1), (3, [1.0] * 32, 1), (4, [1e300] * 16, 1), (5, [1.0] * 3, 1)], "vec_id long, embedding array<double>, label int")
    assert {(r.vec_id, r.error, r.label_error) for r in vector_codes.codes(other).collect()} == {(1, 0, 0), (2, 0, 0)}


def test_nearest_is_exact():
    rnd = np.random.RandomState(3)
    for spread in (2, 40, 1 << 25):
        x, entries = rnd.randint(-spread, spread, (700, 4)), rnd.randint(-spread, spread, (64, 4))
        entries[10] = entries[50]
        every = ((x[:, None, :] - entries) ** 2).sum(axis=2)
        index, apart = vector_codes.nearest(x, entries)
        assert (apart == every.min(axis=1)).all() and (index == every.argmin(axis=1)).all()


def audited(rows, least, top):
    docs = [tuple(x or "" for x in r) for r in rows]
    words = [[w for w in re.split(r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(t)) if w] for t, _, _ in docs]
    out = set()
    for lang in {d[1] for d in docs}:
        seen = Counter(w for ws, d in zip(words, docs) if d[1] == lang for w in set(ws))
        kept = {w for w, n in seen.items() if n >= least}
        counts = {s: Counter() for _, g, s in docs if g == lang}
        for ws, (_, g, s) in zip(words, docs):
            if g == lang:
                counts[s].update(w for w in ws if w in kept)
        share = lambda c: {w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept)) for w in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        shares, whole = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        for s, p in shares.items():
            pairs = sorted((-sum(f(p[w], q[w]) for w in kept), t) for t, q in shares.items() if t != s)
            terms = sorted((-f(p[w], whole[w]), w.encode()) for w in kept if counts[s][w] and p[w] > whole[w])[:top]
            out |= {(lang, s, "pair", t, -v, k + 1) for k, (v, t) in enumerate(pairs)} | {(lang, s, "term", w.decode(), -v, k + 1) for k, (v, w) in enumerate(terms)}
    return out


def test_source_divergence(spark):
    rnd = random.Random(8)
    vocabulary = ["tha", "Ner", "été", "日本", "ß", "q", "tha-ner", "x1y", "İ", "zz"]
    rows = [(" ".join(rnd.choice(vocabulary[: rnd.randint(1, 10)]) for _ in range(rnd.randint(0, 30))), rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "é", None])) for _ in range(90)]
    rows += [(None, "en", "null only"), ("", "es", "s"), ("1 2 3", "es", "t"), ("tha " * 5000, "en", "a"), ("w" * 100000, "fr", "b"), (" tha" * 3, "sole", "one"), *[("same text", "de", "x")] * 12, ("other", "de", "y")]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, n int, term string")
    for least, top in ((10, 10), (1, 2)):
        found = divergence.audit(table.repartition(5), least, top).collect()
        assert len(found) == len(set(found)) and set(map(tuple, found)) == audited(rows, least, top)
    assert divergence.audit(table.limit(0)).count() == 0
