"""The text operators against plain Python on small tables, odd rows included."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from registra.llm import bpe, bpe_codec, common, embeddings, fingerprints, language_model, lines, minhash, packing, quality, substrings, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")

rnd = random.Random(4)
SYLLABLES = ["tha", "ner", "ing", "ou", "re", "st", "an", "edh", "wh", "ble"]


def word():
    return "".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 3)))


def prose(n, width=12):
    return "\n".join(" ".join(word() for _ in range(width)) + "." for _ in range(n // width))


BASE, PASSAGE = prose(240), " ".join(word() for _ in range(70))
TEXTS = [
    BASE, BASE, BASE.replace("tha", "tho", 2), prose(120) + "\n" + PASSAGE + "\n" + prose(36), PASSAGE + "\n" + prose(96), prose(600), None, "", "   \n\t ", "One", "one",
    "<|endoftext|> a  b\n\n c", "x" * 7000, "Ünïcode ☃ 日本語 🙂 " * 30, "same line here\n" * 60, prose(60).upper(),
]
#: Columns whose names operators use themselves.
CLASHING = "kept string, component_id string, id string, text_b string, n_lines string, spans string, score string, bands string, x string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), *["c"] * 9) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words(text):
    return (text or "").encode().lower().split()


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


# tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_counts_and_codec(docs, none, library):
    counts = {r.doc_id: r for r in token_counts.token_counts(docs, PATH).collect()}
    digests = {r.doc_id: r for r in bpe_codec.codec_digests(docs, PATH).collect()}
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert counts[i].n_tokens == len(ids) == digests[i].n_tokens and counts[i].n_bytes == len((t or "").encode()) and counts[i].over_limit == (len(ids) > 1024)
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert token_counts.token_counts(none, PATH).count() == 0 and bpe_codec.codec_digests(none, PATH).count() == 0
    back = {r.doc_id: r.text for r in bpe_codec.decode(bpe_codec.encode(docs, PATH), PATH).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_counts_with_sentencepiece(docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path).collect()} == {i: len(model.encode(t or "")) for i, t in enumerate(TEXTS)}


def random_merges(seed, n):
    r, tokens = random.Random(seed), [b"a", b"b", b"c"]
    merges = []
    while len(merges) < n:
        pair = (r.choice(tokens), r.choice(tokens))
        if pair not in merges and len(pair[0] + pair[1]) <= 6 and pair[0] + pair[1] not in tokens:
            merges.append(pair)
            tokens.append(pair[0] + pair[1])
    return bpe.MergeList({t: i for i, t in enumerate(tokens)}, merges)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 30), st.binary(max_size=120).map(lambda b: bytes(97 + x % 3 for x in b)), st.integers(1, 9))
def test_stream_equals_whole(seed, piece, chunk):
    """The transducer, with the smallest blocks, gives what merging the whole piece at once gives."""
    merges = random_merges(seed, 12)
    parts = [piece[i : i + chunk] for i in range(0, len(piece), chunk)]
    assert list(merges.stream(parts, block=1)) == merges.merge(piece) == merges._merge_by_heap([merges.first[b] for b in piece])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["ab", " ", "  ", "'s", "'r", "e", "12", "\n", "\t", "..", "日本", "é", "🙂", "<|endoftext|>", "<|end", "x" * 30, " word", "\u00a0"]), max_size=60), st.integers(6, 40))
def test_blocks_encode_as_the_whole(library_parts, block):
    text = "".join(library_parts)
    from tokenizers import Tokenizer

    if not hasattr(test_blocks_encode_as_the_whole, "library"):
        test_blocks_encode_as_the_whole.library = Tokenizer.from_file(PATH)
    want = test_blocks_encode_as_the_whole.library.encode(text, add_special_tokens=False).ids
    assert list(np.frombuffer(b"".join(bpe_codec.encoded_blocks(text, PATH, block)), "<u4")) == want


def test_memory_of_long_texts_is_bounded():
    """Neither a long text nor a long pre-token makes memory grow."""
    import tracemalloc

    peaks = []
    for n in (1, 8):
        for text in ("some words of a line, again and again\n" * (n * 6_000), "abcdefghij" * (n * 4_000)):
            bpe_codec.digests(text[:1000], PATH)
            tracemalloc.start()
            bpe_codec.digests(text, PATH)
            peaks.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
    assert peaks[2] < 1.3 * peaks[0] + 500_000 and peaks[3] < 1.3 * peaks[1] + 500_000


def test_decoder_waits_for_characters():
    merges = bpe.merge_list(PATH)
    ids = [i for b in "☃🙂é".encode() for i in [merges.first[b]]]
    decoder = bpe.TextDecoder(merges)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == "☃🙂é"


def test_packing(docs, none, library):
    pieces = packing.pack(docs, PATH).toPandas()
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in enumerate(TEXTS)}
    for i, own in pieces.groupby("doc_id"):
        own = own.sort_values("start")
        assert own["length"].sum() == len(ids[i]) and (own["doc_tokens"] == len(ids[i])).all()
        assert list(own["start"]) == [0, *own["length"].cumsum()[:-1]]
        assert all(zlib.crc32(ids[i][s : s + n].tobytes()) == c for s, n, c in zip(own["start"], own["length"], own["ids_crc32"]))
    assert set(pieces["doc_id"]) == set(ids)
    padding = 0
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert list(own["offset"]) == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() <= 1024
        total = int(own["length"].sum())
        padding += 0 if total & (total - 1) == 0 else 1024 - total
    assert padding == 0 and packing.pack(none, PATH).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 60), st.dictionaries(st.integers(1, 40), st.integers(1, 3), max_size=6))
def test_closest_fill(room, counts):
    used = packing.closest_fill(room, counts)
    assert all(0 < n <= counts[x] for x, n in used.items())
    sums = {0}
    for x, n in counts.items():
        sums = {s + k * x for s in sums for k in range(n + 1) if s + k * x <= room}
    assert sum(x * n for x, n in used.items()) == max(sums)


# duplicates


def test_minhash(docs, none):
    for width in (2, 5):
        out = {r.doc_id: r for r in minhash.near_duplicates(docs, width).collect()}
        sets = []
        for t in TEXTS:
            w = words(t)
            sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
        links = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        assert [out[i].component_id for i in range(len(sets))] == components(len(sets), links)
        assert [out[i].n_shingles for i in range(len(sets))] == [len(s) for s in sets] and all(r.kept == (r.component_id == r.doc_id) for r in out.values())
    assert minhash.near_duplicates(none).count() == 0


def test_minhash_strays(spark):
    """A family whose members are linked along a path only, through one bucket's leftovers."""
    r = random.Random(2)
    family, base = [], [f"w{i}" for i in range(120)]
    for _ in range(60):
        w = list(base)
        for k in r.sample(range(120), r.randint(2, 14)):
            w[k] = f"z{r.randint(0, 9)}"
        family.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(family)), "doc_id long, text string")
    sets = [{tuple(t.split()[i : i + 2]) for i in range(119)} for t in family]
    links = [(a, b) for a in range(60) for b in range(a + 1, 60) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    out = {x.doc_id: x.component_id for x in minhash.near_duplicates(df, 2).collect()}
    assert [out[i] for i in range(60)] == components(60, links)


def test_minhash_templates(spark):
    """A family of one template whose members are no links of each other, among which some have near-copies."""
    r = random.Random(5)
    texts = []
    for _ in range(700):
        w = [f"w{i}" for i in range(200)]
        for k in range(15):
            w[13 * k + 3] = f"z{r.getrandbits(40)}"
        texts.append(w)
    texts += [[*texts[7 * i][:-1], f"copy{i}"] for i in range(30)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    out = {x.doc_id: x.component_id for x in minhash.near_duplicates(df, 2).collect()}
    assert out == {i: i if i < 700 else 7 * (i - 700) for i in range(730)}


@given(st.lists(st.sets(st.integers(0, 60)), max_size=30), st.lists(st.sets(st.integers(0, 60)), max_size=30), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_overlaps_are_those_of_the_sets(xs, ys, abreast):
    as_hashes = lambda sets: [np.array(sorted(s), np.uint64) for s in sets]
    found = minhash.overlaps(as_hashes(xs), as_hashes(ys), abreast)
    assert found.shape == (len(xs), len(ys)) and found.tolist() == [[len(x & y) for y in ys] for x in xs]


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (4, 1), *[(100 + i, 101 + i) for i in range(40)]]
    out = {r.id: r.component for r in common.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, **{100 + i: 100 for i in range(41)}}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def kept_lines(texts, width=8):
    seen, sets, out = [], [], []
    every = [(i, k, line) for i, t in enumerate(texts) if t for k, line in enumerate(t.split("\n")) if line.strip()]
    sets = [{line[j : j + width] for j in range(max(1, len(line) - width + 1))} for _, _, line in every]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    first = [c == i for i, c in enumerate(components(len(every), links))]
    gone = {(i, k) for (i, k, _), f in zip(every, first) if not f}
    del seen
    for i, t in enumerate(texts):
        out.append(None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone))
    return out


def test_lines(docs, none):
    out = lines.dedup(docs)
    assert set(docs.columns) <= set(out.columns)
    found = {r.doc_id: r for r in out.collect()}
    assert [found[i].text for i in range(len(TEXTS))] == kept_lines(TEXTS)
    assert found[6].n_lines == 0 and found[14].n_kept == 2
    rows = docs.selectExpr("doc_id AS id", "text AS line").where("line IS NOT NULL")
    plan = lines.signed(rows, 8).join(lines.sketched(rows, 8), "id")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and lines.dedup(none).count() == 0


def _jaccard(x, y):
    one, two = ({t[i : i + 8] for i in range(max(1, len(t) - 7))} for t in (x, y))
    return len(one & two) / len(one | two)


def test_recall_by_kind_of_line(spark):
    """Pairs just above the threshold, of words, addresses, hex, base64 and characters without blanks."""
    r = random.Random(8)
    alphabets = {"hex": "0123456789abcdef", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "cjk": "".join(map(chr, range(0x4E00, 0x4E80)))}
    make = {k: (lambda a=a: "".join(r.choice(a) for _ in range(160))) for k, a in alphabets.items()}
    make["words"] = lambda: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(30))
    make["urls"] = lambda: "https://" + "/".join("".join(r.choice("klmnopqrst") for _ in range(6)) for _ in range(22))
    texts, pairs = [], {}
    for kind, line in make.items():
        while len(pairs.setdefault(kind, [])) < 60:
            x = line()
            y = list(x)
            for _ in range(r.randint(1, 3)):
                y[r.randrange(len(y))] = r.choice("0123456789")
            y = "".join(y)
            if x != y and 0.8 <= _jaccard(x, y) <= 0.86:
                pairs[kind].append(len(texts))
                texts += [x, y]
    out = {r.doc_id: r.n_kept for r in lines.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for kind, firsts in pairs.items():
        assert sum(out[i] == 1 and out[i + 1] == 0 for i in firsts) >= 0.95 * len(firsts), kind


def test_blank_lines_stay(spark):
    texts = ["one line of words here\r\n\r\n\t\r\nanother line of words\r", "one line of words here\r\n\r\nand a third, not like them\r"]
    out = {r.doc_id: r.text for r in lines.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert out == {0: texts[0], 1: "\r\nand a third, not like them\r"}


def test_families_without_links_and_with_chains(spark):
    """Lines that share most shingles but are no links, and lines linked only by way of others."""
    r = random.Random(3)
    base = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))

    def changed(text, n):
        out = list(text)
        for at in r.sample(range(len(out)), n):
            out[at] = r.choice("0123456789")
        return "".join(out)

    texts = [changed(base, 5) for _ in range(60)]
    chain = [changed(base[::-1], 0)]
    for _ in range(20):
        chain.append(changed(chain[-1], 2))
    texts += chain
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if _jaccard(texts[i], texts[j]) >= 0.8]
    want = components(len(texts), linked)
    out = {r.doc_id: r.n_kept for r in lines.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert out == {i: int(want[i] == i) for i in range(len(texts))}


@pytest.mark.parametrize("direct", [2, 64])
def test_templated_lines(spark, monkeypatch, direct):
    """Lines of one template that keep a fifth, or just less, for themselves; some have near-copies that no first
    line of a bucket leads to."""
    monkeypatch.setattr(lines, "DIRECT", direct)
    r = random.Random(12)
    base = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(120))
    own = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    texts = [base[:60] + own(n) + base[60:] for n in (8, 12) for _ in range(90)]
    texts += [texts[4 * i] + own(2) for i in range(30)]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if _jaccard(texts[i], texts[j]) >= 0.8]
    want = components(len(texts), linked)
    out = {r.doc_id: r.n_kept for r in lines.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert out == {i: int(want[i] == i) for i in range(len(texts))}


def test_shingles_of_one_component_are_not_joined(spark, monkeypatch):
    """Lines that are one component already bring no rows to the join of rare shingles; those of others still meet."""
    r = random.Random(13)
    own = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    one, two = own(120), own(120)
    texts = [one + own(3) for _ in range(100)] + [two + own(2) for _ in range(2)]
    rows = [(i, t, len({t[k : k + 8] for k in range(len(t) - 7)}), 0 if i < 100 else i, [1]) for i, t in enumerate(texts)]
    made, materialize = {}, common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, label: made.setdefault(label, materialize(df, label)))
    found = lines._rare_pairs(spark.createDataFrame(rows, "id long, line string, n long, component long, met array<long>"), 8, 80).collect()
    assert [(x.a, x.b) for x in found] == [(100, 101)]
    assert {x.id for x in made["rare"].collect()} == {100, 101}


@pytest.mark.parametrize("run", [lines.dedup, substrings.dedup])
def test_no_join_depends_on_the_size_of_a_side(spark, monkeypatch, docs, run):
    """What is shuffled grows with the input: no side is broadcast for being small, and the setting is put back."""
    key, materialize = "spark.sql.autoBroadcastJoinThreshold", common.materialize
    before, seen = spark.conf.get(key), set()
    monkeypatch.setattr(common, "materialize", lambda df, label, *by: (seen.add(spark.conf.get(key)), materialize(df, label, *by))[1])
    out = run(docs)
    assert seen == {"-1"} and spark.conf.get(key) == before
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_similar_short_lines_are_found(spark):
    """Lines that differ in a few characters only, against brute force: at most one pair in 100 is lost."""
    r, pairs = random.Random(11), []
    while len(pairs) < 400:
        line = " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 11))) for _ in range(r.randint(4, 14)))
        a, b = (f"{line} {r.randrange(1000)}" for _ in range(2))
        x, y = ({t[i : i + 8] for i in range(len(t) - 7)} for t in (a, b))
        if a != b and 100 * len(x & y) >= 80 * len(x | y):
            pairs.append((a, b))
    rows = [(2 * i + side, line) for i, pair in enumerate(pairs) for side, line in enumerate(pair)]
    gone = {x.doc_id for x in lines.duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(i % 2 for i in gone) and len(gone) >= 396


def test_substrings(docs, none):
    out = {r.doc_id: r for r in substrings.dedup(docs).collect()}
    seen = set()
    for i, t in enumerate(TEXTS):
        w, cover = words(t), set()
        for s in range(len(w) - 49):
            key = tuple(w[s : s + 50])
            cover |= set(range(s, s + 50)) if key in seen else set()
            seen.add(key)
        got = {j for x in out[i].spans for j in range(x.start, x.end)}
        assert cover <= got and out[i].n_words == len(w) and out[i].n_removed == len(got)
        assert words(out[i].text) == [x for j, x in enumerate(w) if j not in got]
    assert out[4].n_removed >= 70 and out[3].n_removed == 0 and out[5].n_removed == 0 and out[6].text is None
    assert substrings.dedup(none).count() == 0


@pytest.mark.parametrize("chunk", [4096, 3])
def test_later_variants_meet(spark, monkeypatch, chunk):
    """A near-copy is found though older documents hold variants that are near to neither, and within one document."""
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    r, rows = random.Random(8), []
    filler = lambda n: [f"f{r.randrange(10**9)}" for _ in range(n)]
    for case in range(12):
        form = [f"c{case}w{i}" for i in range(60)]

        def variant(places):
            return " ".join([*filler(30), *[f"v{r.randrange(10**9)}" if i in places else w for i, w in enumerate(form)], *filler(30)])  # noqa: B023

        texts = [variant(range(k, 60, 10)) for k in range(10)] + [variant([30]), variant([])]
        rows += [(100 * case + i, t) for i, t in enumerate(texts)]
        rows.append((100 * case + 50, " ".join([" ".join(filler(40)), variant([]).replace("c", "d"), variant([20]).replace("c", "d")])))
    found = {x.doc_id: x.spans for x in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i % 100 for i in found} == {11, 50}
    assert sum(i % 100 == 11 for i in found) >= 10 and sum(i % 100 == 50 for i in found) >= 10
    assert all(x.start >= 160 for i, spans in found.items() if i % 100 == 50 for x in spans)


def _shuffled(spark, run) -> int:
    """Bytes that stages shuffle while ``run`` is at work."""
    store, wait = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty
    wait()
    last = max((s.stageId() for s in _stages(store)), default=-1)
    run()
    wait()
    return sum(s.shuffleWriteBytes() for s in _stages(store) if s.stageId() > last)


def _stages(store) -> list:
    found = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
    return [found.apply(i) for i in range(found.size())]


def test_texts_are_shuffled_once(spark, tmp_path):
    """Whatever is joined to texts on the way goes to where they lie; texts that nobody asks for stay there."""
    r = random.Random(12)
    text = lambda n: " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=12)) for _ in range(n))
    rows = [(i, text(2000)) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs, size = spark.read.parquet(f"{tmp_path}/documents.parquet"), sum(len(t) for _, t in rows)
    assert _shuffled(spark, lambda: substrings.dedup(docs).select("doc_id", "n_words", "n_removed", "spans").collect()) < 2 * size


def test_lines_meet_their_classes_by_keys(spark, monkeypatch):
    """The join of all lines with their components shuffles no line's text."""
    plans, materialize = {}, common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, label, *by: (plans.setdefault(label, df._jdf.queryExecution().executedPlan()), materialize(df, label, *by))[1])
    docs = spark.createDataFrame([(1, "one line of words\nand another"), (2, "one line of words")], "doc_id long, text string")
    assert [r.doc_id for r in lines.duplicate_lines(docs).collect()] == [2]
    shuffled = plans["classes"].toString()
    assert "Exchange hashpartitioning(id" in shuffled and not _sent(plans["classes"], "line")


def _sent(plan, column: str) -> bool:
    """Whether an exchange of an initial plan has a column of that name."""
    nodes = [plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan]
    for node in nodes:
        if node.nodeName() == "Exchange" and column in [node.output().apply(i).name() for i in range(node.output().size())]:
            return True
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return False


def test_alike_windows_are_told_at_once(spark, monkeypatch):
    """Passages are hashed one by one only where windows of a key differ, and the first of equal passages stays."""
    r, made = random.Random(13), []
    noise = lambda n: [f"n{r.randrange(10**9)}" for _ in range(n)]
    passage, seen, texts = noise(400), set(), []
    for i in range(8):
        cut = passage[10 * i : 400 - 7 * i]
        texts.append(" ".join([*noise(20), *cut, *noise(20), *(cut[-120:] if i % 2 else []), *noise(5)]))
    passages = substrings._whole_passages
    monkeypatch.setattr(substrings, "_whole_passages", lambda docs: (made.append(passages(docs).count()), passages(docs))[1])
    out = {x.doc_id: x.spans for x in substrings.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    copied = 0
    for i, t in enumerate(texts):
        w, cover = words(t), set()
        for s in range(len(w) - 49):
            copied += (key := tuple(w[s : s + 50])) in seen
            cover |= set(range(s, s + 50)) if key in seen else set()
            seen.add(key)
        assert cover <= {j for x in out.get(i, []) for j in range(x.start, x.end)}
    assert 0 not in out and made[0] < copied / 2, (made, copied)


def test_fragments_before_copies(spark):
    """Two near-copies find each other though an older document holds shorter fragments of them."""
    r, rows = random.Random(9), []
    for case in range(60):
        passage = [f"p{case}w{i}" for i in range(120)]
        other = list(passage)
        for at in r.sample(range(120), 2):
            other[at] = f"x{r.randrange(10**9)}"
        noise = lambda n: [f"n{r.randrange(10**9)}" for _ in range(n)]
        rows += [
            (3 * case, " ".join([*noise(30), *passage[:45], *noise(30), *passage[70:115], *noise(30)])),
            (3 * case + 1, " ".join([*noise(20), *passage, *noise(20)])), (3 * case + 2, " ".join([*noise(25), *other, *noise(15)])),
        ]
    found = {x.doc_id: x.spans for x in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    whole = [i for i, spans in found.items() if i % 3 == 2 and sum(x.end - x.start for x in spans) >= 100]
    assert len(whole) >= 57 and not any(i % 3 == 0 for i in found)


def test_near_passages():
    a = [b"w%d" % i for i in range(80)]
    b = list(a)
    b[20] = b"other"
    anchors = [(i, i + 5) for i in (0, 30, 70)]
    assert substrings.align(b, [b"x"] * 5 + a, anchors) == [(0, 80)]
    assert substrings.align(b[:40], [b"x"] * 5 + a, anchors[:1]) == []


def test_near_passages_between_other_words():
    """Two passages of a form are found though the words between them differ; so are interleaved ones."""
    a = [b"w%d" % i for i in range(150)]
    b = a[:30] + [b"x"] + a[31:60] + [b"y%d" % i for i in range(30)] + a[90:120] + [b"z"] + a[121:]
    anchors = [(i, i) for i in (0, 10, 40, 55, 92, 110, 130, 145)]
    assert substrings.align(b, a, anchors) == [(0, 60), (90, 150)]
    c = [b"v%d" % i for i in range(60)]
    places = [200 * k for k in range(6)]
    many = sum(([*c, *[b"f%d.%d" % (k, i) for i in range(140)]] for k in range(6)), [])
    assert set(substrings.align(c, many, [(x, p + x) for x in range(0, 56, 5) for p in places])) == {(0, 60)}
    assert len(substrings.align(c, many, [(x, p + x) for x in range(0, 56, 5) for p in places])) == 6


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.integers(2, 8))
def test_compact_windows(values, least):
    """Every passage of ``least`` shingles or more lies in exactly one window of each hash, at its minimum."""
    rng = np.random.RandomState(1).randint(0, 1 << 62, 10).astype(np.uint64)
    k, left, c, right = substrings.compact_windows(rng[values], least=least)
    for i in range(len(values)):
        for j in range(i + least - 1, len(values)):
            for h in range(substrings.HASHES):
                assert sum((k == h) & (left <= i) & (i <= c) & (c <= j) & (j <= right)) == 1


def test_embeddings(spark):
    r = np.random.RandomState(0)
    base = r.normal(size=(60, 24))
    near = base[0] + r.normal(size=(40, 24)) * 0.16 * np.linalg.norm(base[0]) / 24**0.5
    rows = [[float(x) for x in v] for v in np.vstack([base, near, base[1:3], 3 * base[3:4]])]
    odd = [None, [], [0.0] * 24, [1.0, None] + [0.0] * 22, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0, 2.0]]
    df = spark.createDataFrame([(i, v, 0, "k") for i, v in enumerate(rows + odd)], "vec_id long, embedding array<float>, label int, key string")
    x = np.array(rows, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    out = {q.vec_id: q for q in embeddings.near_duplicates(df, tile=16).collect()}
    n = len(rows)
    assert [out[i].n_links for i in range(n)] == linked.sum(axis=1).tolist()
    assert [out[i].component_id for i in range(n)] == components(n, zip(*np.nonzero(linked)))
    assert all(out[n + i].n_links == 0 and out[n + i].kept for i in range(len(odd)))
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased():
    r = np.random.RandomState(3)
    v = r.normal(size=(2000, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    w = v[::-1] * 0.3 + v * 0.95
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    turned = v @ embeddings.rotations(64, 192)
    code = np.packbits(turned > 0, axis=1, bitorder="little").view(np.int64)
    factors = np.abs(turned).reshape(2000, 3, 64).sum(axis=2) / 8
    guess, error = embeddings.estimate(w, code, factors)
    true = (v * w).sum(axis=1)
    assert abs((guess - true).mean()) < 3 * error.mean() / 2000**0.5 and (abs(guess - true) < 5 * error).all()


# fingerprints, quality, language model


def test_fingerprints(docs, none):
    out = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    n = len(TEXTS)
    for i in range(n):
        text, after = TEXTS[i] or "", TEXTS[(i - 1) % n] or ""
        half = len(text) // 2
        assert out[i].n_chars == len(text)
        assert out[i].edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
        assert 0 <= out[i].near_edited <= 1 and 0 <= out[i].near_next <= 1
    for i in range(n):
        for j in range(n):
            assert (out[i].fingerprint == out[j].fingerprint) == ((TEXTS[i] or "") == (TEXTS[j] or ""))
    assert out[1].near_next == 1 and out[5].near_edited > out[5].near_next + 0.2
    assert fingerprints.edited_fingerprints(none).count() == 0


def lanes(text):
    """Lanes of a text's fingerprint, by the rule."""
    hashed = lambda data, seed: xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), xxhash.xxh64_intdigest(data, 42))
    exact, signed = [0] * 8, [0] * 128
    for line in text.split("\n"):
        for i in range(4):
            h = hashed(line.encode(), i + 1)
            exact[2 * i] += h & 0xFFFFFFFF
            exact[2 * i + 1] += h >> 32
        wide = line.encode("utf-16-be")
        for at in range(0, max(1, len(wide)), 96):
            for j in range(128):
                signed[j] += 2 * (hashed(wide[at : at + 96], 101 + j // 64) >> j % 64 & 1) - 1
    return [x % (1 << 32) for x in exact], signed


def likeness(a, b):
    own = sum(x * x + y * y for x, y in zip(a, b))
    apart = sum((x - y) ** 2 for x, y in zip(a, b))
    return max(0.0, 1 - apart / own) if own else float(not apart)


def test_fingerprints_by_the_rule(spark):
    """Ids of 64 bits with one far outlier; fingerprints and likenesses against plain Python; a tiny range size."""
    r = random.Random(5)
    ids = sorted({r.randrange(-(1 << 63), 1 << 63) for _ in range(40)} | {0, 1, 2, -1, (1 << 62) + 1}, reverse=True)
    texts = {i: r.choice([prose(24), prose(60), "", None, "same\r\ntext\n"]) for i in ids}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {x.doc_id: x for x in fingerprints.edited_fingerprints(rows).collect()}
    assert sorted(out, reverse=True) == ids
    for i, after in zip(ids, [*ids[1:], ids[0]]):
        text, other = texts[i] or "", texts[after] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and out[i].n_chars == len(text)
        for t, found in ((text, out[i].fingerprint), (edited, out[i].edited_fingerprint)):
            exact, signed = lanes(t)
            assert base64.b64decode(found) == b"".join((x % (1 << 32)).to_bytes(4, "big") for x in exact + signed)
        own = lanes(text)[1]
        assert math.isclose(out[i].near_edited, likeness(own, lanes(edited)[1]), abs_tol=1e-9)
        assert math.isclose(out[i].near_next, likeness(own, lanes(other)[1]), abs_tol=1e-9)


def test_ranges_deal_evenly(spark, monkeypatch):
    """An outlier leaves the ranges even; two levels of ranges follow each other as one does."""
    ids = spark.range(2000).selectExpr("id AS doc_id").unionByName(spark.createDataFrame([(1 << 55,)], "doc_id long"))
    sizes = [r["count"] for r in fingerprints._dealt(ids, "doc_id", 50).groupBy("bucket").count().collect()]
    assert len(sizes) >= 35 and max(sizes) <= 100
    monkeypatch.setattr(fingerprints, "MOST_RANGES", 8)
    assert fingerprints._dealt(ids, "doc_id", 50).select("bucket").distinct().count() >= 30
    led = {r.doc_id: r.next_id for r in fingerprints.following(ids, 50).collect()}
    order = [1 << 55, *range(1999, -1, -1)]
    assert led == dict(zip(order, [*order[1:], order[0]]))


def test_fingerprints_are_homomorphic(spark):
    from pyspark.sql import functions as F

    texts = [("a", "one\ntwo"), ("b", "three"), ("c", "three\ntwo\none"), ("d", "two\nthree\none")]
    rows = spark.createDataFrame(texts, "doc_id string, text string")
    out = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(rows).collect()}
    add = spark.createDataFrame([(out["a"], out["b"], out["c"])], "a string, b string, c string")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    both, less, near = add.select(fingerprints.combine(a, b), fingerprints.combine(c, b, True), fingerprints.likeness_of(a, c)).first()
    assert both == out["c"] == out["d"] and less == out["a"]
    assert math.isclose(near, likeness(lanes("one\ntwo")[1], lanes("three\ntwo\none")[1]), abs_tol=1e-9)


def test_quality(spark, docs, none):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        text = prose(r.randint(24, 120))
        good = i % 3 > 0
        rows.append((i, text if good else text.replace(" ", "!! ").upper()))
        labels.append((i, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, quality int")
    out = quality.quality(df, marks).toPandas().set_index("doc_id")
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert list(out.index[out["held_out"]].sort_values()) == held and ((out["score"] >= 0) & (out["score"] <= 1)).all()
    assert np.mean([out["predicted"][i] == int(i % 3 > 0) for i in held]) > 0.95
    assert quality.quality(docs, marks).count() == len(TEXTS) and quality.quality(none, marks).count() == 0
    assert {x.score for x in quality.quality(docs, marks.limit(0)).collect()} == {0.5}
    levels = quality.isotonic(np.array([3.0, 1, 2, 5]), np.array([4.0, 4, 4, 5]))
    assert (np.diff(levels) >= 0).all() and abs(levels[0] - 0.5) < 1e-9


def test_language_model(spark, docs, none):
    out = {r.doc_id: r for r in language_model.scores(docs, PATH).collect()}
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(TEXTS))]
    tokens = [[*words(t), None] for t in TEXTS]
    counts = Counter(w for w, h in zip(tokens, held) if not h for w in w)
    n, v = sum(counts.values()), len(counts)
    for i, w in enumerate(tokens):
        assert (out[i].held_out, out[i].n_tokens, out[i].n_known, out[i].train_tokens) == (held[i], len(w), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(out[i].base_score, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel_tol=1e-9) and out[i].score < 0
    assert language_model.scores(none, PATH).count() == 0


def test_every_document_teaches_whatever_the_layout(spark):
    """All ids of all training documents are learned from, and partitions do not change the model."""
    r = random.Random(6)
    vocabulary = [word() for _ in range(60)]
    texts = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 60)))) for i in range(80)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    gathered = language_model._gathered(docs, PATH, 4)
    assert gathered.where("kind = 2").count() == 80 and gathered.where("kind = 2").select("round").distinct().count() == 4
    one, eight = ({x.doc_id: x.score for x in language_model.scores(docs.repartition(n), PATH, rounds=4).collect()} for n in (1, 8))
    assert all(math.isclose(one[i], eight[i], rel_tol=1e-5) for i in one) and len(one) == 80


def test_scores_by_the_rule(spark):
    """Mixed word by word, rare words by way of the join as well; words never seen by attention alone."""
    docs = spark.createDataFrame([(i, f"common words here and number{i}") for i in range(30)], "doc_id long, text string")
    language_model.FREQUENT, before = 3, language_model.FREQUENT
    try:
        few = {x.doc_id: x for x in language_model.scores(docs, PATH, rounds=2).collect()}
    finally:
        language_model.FREQUENT = before
    every = {x.doc_id: x for x in language_model.scores(docs, PATH, rounds=2).collect()}
    for i in every:
        assert math.isclose(few[i].score, every[i].score, rel_tol=1e-6) and math.isclose(few[i].base_score, every[i].base_score, rel_tol=1e-9)
        assert few[i].n_known == every[i].n_known
        floor = max(every[i].attention_score + every[i].n_tokens * math.log10(0.25), every[i].base_score + every[i].n_tokens * math.log10(0.75))
        assert every[i].score >= floor - 1e-9


def test_attention_is_a_distribution_and_learns():
    from registra.llm import attention

    size = 40
    r = np.random.RandomState(0)
    ids = np.array([(i * 7) % 30 for i in range(3000)], np.int32)
    counts = np.bincount(ids, minlength=size).astype(float)
    classes = attention.Classes(counts, r.rand(size) < 0.5, r.rand(size) < 0.5, size - 1)
    params = attention.start(classes)
    wins = attention.windows(ids, size - 1)
    assert sorted(wins[:, attention.CONTEXT :].ravel()[: len(ids)]) == sorted(ids)
    before = np.log(attention.probabilities(params, classes, wins)).sum()
    # each gradient against a difference
    g = attention.shaped(attention.gradients(params, classes, wins[:8]))
    loss = lambda q: -np.log(attention.probabilities(q, classes, wins[:8])).sum()
    for key in ("q", "v", "o", "place", "b", "c", "x", "e"):
        up, down = ({**params, key: params[key] + s * 1e-2 * np.sign(g[key])} for s in (1, -1))
        assert math.isclose((loss(up) - loss(down)) / 2e-2, abs(g[key]).sum(), rel_tol=0.1, abs_tol=1e-1), key
    values, adam = attention.flat(params).astype(float), attention.Adam(len(attention.flat(params)), 0.03)
    for _ in range(40):
        values = adam.step(values, attention.gradients(attention.shaped(values), classes, wins) / len(ids))
    learned = attention.shaped(values)
    assert np.log(attention.probabilities(learned, classes, wins)).sum() > before + 1000
    one = np.repeat(wins[5:6], size, axis=0).copy()
    one[:, attention.CONTEXT] = np.arange(size)
    assert abs(attention.probabilities(learned, classes, one)[:, 0].sum() - 1) < 1e-4
    follows = np.zeros((attention.INPUT_ROWS, len(classes.log_prior)))
    np.add.at(follows, (classes.row[ids[:-1]], classes.of[ids[1:]]), 1)
    told = attention.start(classes, follows)
    assert np.log(attention.probabilities(told, classes, wins)).sum() > before + 1000


ODD = "row string, rare string, bucket string, place string, end string, at string, line string, key string, word string, class string, d string, n string, h string"
WIDE = [-(1 << 63), (1 << 62) + 1, (1 << 62) + 3, -5, 0, 7, 7, None, None]


@pytest.fixture(scope="module")
def odd(spark):
    """Wide and negative ids, one shared by two rows, two missing, and columns named as operators name their own."""
    texts = [BASE, BASE, prose(60), "short", None, PASSAGE + "\r\n" + PASSAGE, "other text of the same id", BASE, ""]
    rows = [(i, t, "en", "s", 1, *["c"] * 13) for i, t in zip(WIDE, texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {ODD}")


def test_working_tables_go_with_their_operator(spark, docs, tmp_path):
    """What an operator leaves in the shared folder is its result; on a cluster an unset folder is an error."""
    before = spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(ValueError):
        common.shared_dir(FakeCluster())
    import os

    folder = f"{before.removeprefix('file://')}/registra"
    held = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    minhash.near_duplicates(docs).count()
    assert [n.rpartition("-")[0] for n in set(os.listdir(folder)) - held] == ["components"]


class FakeCluster:
    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://somewhere:7077"


def test_odd_tables(spark, odd, none):
    from collections import Counter as C

    labels = spark.createDataFrame([(0, 1), (7, 0), (None, 1)], "doc_id long, quality int")
    every = {
        "codec": bpe_codec.codec_digests(odd, PATH), "counts": token_counts.token_counts(odd, PATH), "minhash": minhash.near_duplicates(odd),
        "quality": quality.quality(odd, labels), "model": language_model.scores(odd, PATH, rounds=2), "prints": fingerprints.fingerprints(odd),
        "lines": lines.dedup(odd), "substrings": substrings.dedup(odd),
    }
    found = {k: df.collect() for k, df in every.items()}
    for k, rows in found.items():
        assert C(r.doc_id for r in rows) == C(WIDE), k
    assert {r.doc_id for r in packing.pack(odd, PATH).collect()} == set(WIDE)
    assert C(r.doc_id for r in fingerprints.edited_fingerprints(odd).collect()) == C(i for i in WIDE if i is not None)
    component = {r.doc_id: r.component_id for r in found["minhash"]}
    assert component[WIDE[1]] == WIDE[0] and component[None] is None
    gone = {r.doc_id: r.n_lines - r.n_kept for r in found["lines"]}
    assert gone[WIDE[1]] >= len(BASE.split("\n")) - 1 and gone[WIDE[0]] < 3
    assert {r.n_removed > 0 for r in found["substrings"] if r.doc_id == WIDE[1]} == {True}
    assert all(set(odd.columns) <= set(every[k].columns) for k in ("lines", "substrings"))
    empty = labels.limit(0)
    assert quality.quality(none, empty).count() == packing.pack(none, PATH).count() == bpe_codec.codec_digests(none, PATH).count() == 0
    vectors = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (-(1 << 63), [1.0, 0.0]), (5, [1.0, 0.01]), (5, [0.0, 1.0]), (6, None)]
    links = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()}
    assert links[None].n_links == 0 and links[None].component_id is None and links[5].component_id == -(1 << 63)


def test_pipeline(spark, docs, tmp_path):
    corpus = pytest.importorskip("corpus_pipeline")
    docs = docs.select(*corpus.COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(len(TEXTS))], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for k, (_, stage) in enumerate(corpus.STAGES[:-1]):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        assert now.columns == docs.columns
    left = {r.doc_id: r.text for r in now.collect()}
    assert 0 in left and 1 not in left and left[5] == TEXTS[5] and 6 in left and 7 in left
    packed = corpus.STAGES[-1][1](spark, now, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == set(left)
    whole = corpus.run(spark, str(tmp_path)).groupBy("doc_id").sum("length").collect()
    assert sorted(whole) == sorted(packed.groupBy("doc_id").sum("length").collect())


def test_language_model_passes_few_texts_at_once(spark, monkeypatch):
    key, materialize, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", common.materialize, {}
    before = spark.conf.get(key)
    monkeypatch.setattr(common, "materialize", lambda df, label, *by: (seen.setdefault(label, spark.conf.get(key)), materialize(df, label, *by))[1])
    rows = [(i, "the end of the line " * (i % 4), 0) for i in range(40)]
    out = language_model.scores(spark.createDataFrame(rows, "doc_id long, text string, x int"), PATH, rounds=2)
    assert out.count() == 40 and out.where("score < 0 AND n_known = n_tokens").count() == 40
    assert seen["gathered"] == seen["scored"] == "512" and spark.conf.get(key) == before


def test_texts_put_together_have_windows_of_their_own():
    """Words, shingles and compact windows of many texts at once are those of each text."""
    r = random.Random(9)
    texts = [" ".join(r.choice("ab\u00e9C") + str(r.randint(0, 3)) for _ in range(n)) for n in (0, 3, 50, 51, 200, 0, 49, 400)]
    texts += ["", "\t \r\n", "  A  b\x0bc\x0cd \n e ", texts[4].upper()]
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    for size in (1, 500, 1 << 18):
        every, at = {}, 0
        for batch, put in substrings._put_together([frame], size):
            got = np.stack(substrings.compact_windows(put.shingles, texts=(put.begin, put.n)))
            assert (put.of(got[2]) == np.searchsorted(put.begin, got[2], "right") - 1).all()
            for text, begin, n in zip(batch["text"], put.begin, put.n):
                each = [words(text)[i : i + 5] for i in range(len(words(text)) - 4)]
                own = put.shingles[begin : begin + n]
                assert n == len(each) and substrings._number_of_words(text) == len(words(text))
                assert len(set(own.tolist())) == len(set(map(tuple, each)))
                for h, shingle in zip(own.tolist(), each):
                    assert every.setdefault(tuple(shingle), h) == h
                alone = {tuple(w) for w in np.stack(substrings.compact_windows(own)).T.tolist()}
                here = got[:, (got[2] >= begin) & (got[2] < begin + n)] if n else got[:, :0]
                assert {(k, a - begin, c - begin, b - begin) for k, a, c, b in here.T.tolist()} == alone
            at += len(batch)
        assert at == len(texts)


def test_similar_parts_by_the_rule():
    """The longest similar part from each run of equal shingles, by plain sets, also where shingles repeat; a
    long stretch of many runs takes seconds, not a quarter of a minute."""
    import time

    r = random.Random(1)
    for _ in range(150):
        m = r.choice([8, 40, 400])
        x = [r.randint(0, m) for _ in range(r.randint(50, 120))]
        y = [r.randint(0, m) if r.random() < 0.05 else v for v in x]
        one, two = ([tuple(z[i : i + 5]) for i in range(len(z) - 4)] for z in (x, y))
        for s, e in substrings._similar_parts(one, two, 0, 80):
            left = set(one[s : e - 4])
            assert e - s >= 50 and any(100 * len(left & set(two[b:d])) >= 80 * len(left | set(two[b:d])) for b in range(len(two)) for d in range(b + 46, len(two) + 1))
    x = [f"w{i}" for i in range(12_000)]
    y = [f"v{i}" if i % 6 == 5 else w for i, w in enumerate(x)]
    one, two = ([tuple(z[i : i + 5]) for i in range(len(z) - 4)] for z in (x, y))
    began = time.process_time()
    assert substrings._similar_parts(one, two, 0, 80) == [] and time.process_time() - began < 5


@pytest.mark.parametrize("scale", [1, 40])
def test_attention_with_large_exponents(monkeypatch, scale):
    """Exponents taken as they are, or by each row's largest where they are too large, give the same; none overflows."""
    from registra.llm import attention

    r, size = np.random.RandomState(3), 300
    ids = r.randint(0, size - 1, 700).astype(np.int32)
    classes = attention.Classes(np.bincount(ids, minlength=size).astype(float), r.rand(size) < 0.5, r.rand(size) < 0.5, size - 1)
    params = {k: v * np.float32(scale) for k, v in attention.start(classes).items()}
    wins, found = attention.windows(ids, size - 1), []
    for safe in (80.0, -1.0):
        monkeypatch.setattr(attention, "_SAFE", safe)
        found.append((attention.probabilities(params, classes, wins), attention.gradients(params, classes, wins)))
    (p, g), (q, h) = found
    assert np.isfinite(p).all() and np.isfinite(g).all() and np.allclose(p, q, rtol=1e-3, atol=1e-30) and np.allclose(g, h, rtol=1e-3, atol=1e-2 * scale)
