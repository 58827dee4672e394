"""Text operators against brute force, and on rows the given tables don't have."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerlens.llm import byte_bpe, fingerprints, nearest, ngram_join, packing, pii, quality, repeats, url_filters, warc
from ledgerlens.llm.common import shingle_sets

WORDS = "the of and tion enth ly ered thou wor ald mist gren".split()
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string"


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, a shared passage, and empty, null, blank, short and long texts."""
    rng = random.Random(4)

    def words(n):
        return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]

    base, passage = words(120), " ".join(words(60))
    found = [" ".join(base)] * 4
    for i in range(12):
        near = list(base)
        near[rng.randrange(120)] = f"x{i}"
        found.append(" ".join(near))
    found += [" ".join(words(30)) + " " + passage + " " + " ".join(words(30)) for _ in range(6)]
    found += [None, "", " \n", "one", "one two", "One TWO", "a" * 1000, "é" * 300, "ab" * 400, " ".join(words(4000))]
    return found


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", 0, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENT).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


# --- n-gram join -----------------------------------------------------------------------


def brute_groups(texts, like):
    sets = shingle_sets([(t or "").encode() for t in texts], like.words)
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            union = len(sets[i]) + len(sets[j]) - both
            if union and like.share_of * both >= like.share * union:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return {i: (len(sets[i]), root[i]) for i in range(len(texts))}


@pytest.mark.parametrize("like", [ngram_join.Likeness(), ngram_join.Likeness(words=5, share=80)])
def test_linked_groups_are_those_of_all_pairs(docs, texts, like):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked_groups(docs, like).collect()}
    assert found == brute_groups(texts, like)


def test_linked_groups_of_hard_rows(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (5, "A B\tc D"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.linked_groups(df).collect()), key=str)
    assert found == [(3, 3), (3, 3), (5, 3), (7, 7), (None, None)]
    assert ngram_join.linked_groups(empty(spark)).count() == 0


def test_shingles_are_those_of_words():
    text = "The\tquick  brown\nfox the quick brown FOX"
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    wanted = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
    assert len(shingle_sets([text.encode()], 3)[0]) == len(wanted)
    assert [len(s) for s in shingle_sets([b"", b" \n", b"a", b"a b"], 3)] == [0, 0, 1, 1]


def test_tree_finds_all_pairs_within_the_bound():
    rng = np.random.default_rng(2)
    points = rng.poisson(2, (150, 16))
    points[50:100] = points[:50] + rng.integers(0, 2, (50, 16)) * (rng.random((50, 16)) < 0.1)
    sizes, groups, like = points.sum(axis=1), np.arange(150) % 60, ngram_join.Likeness()
    found = {tuple(sorted(p)) for a, b, _ in ngram_join.CountTree(points, sizes, groups).pairs(like) for p in zip(a, b)}
    wanted = {
        (i, j) for i in range(150) for j in range(i + 1, 150)
        if groups[i] != groups[j] and np.minimum(points[i], points[j]).sum() >= like.least_overlap(sizes[i] + sizes[j])
    }
    assert found == wanted and wanted


# --- repeats ---------------------------------------------------------------------------


def brute_repeats(datas, threshold):
    counts = Counter(d[s : s + threshold] for d in datas for s in range(len(d) - threshold + 1))
    for d in datas:
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - threshold + 1):
            if counts[d[s : s + threshold]] > 1:
                gone[s : s + threshold] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        yield len(d), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~gone])).hexdigest()


@pytest.mark.parametrize("large", [20_000, 1])
def test_removed_bytes_are_those_of_all_windows(docs, texts, monkeypatch, large):
    monkeypatch.setattr(repeats, "SURROUNDINGS_PER_TASK_GROUP", large)
    wanted = list(brute_repeats([(t or "").encode() for t in texts], repeats.THRESHOLD))
    found = {r["doc_id"]: tuple(r)[1:] for r in repeats.digest(docs).collect()}
    assert [found[i] for i in range(len(texts))] == wanted


def test_removed_repeats_keep_columns_and_rows(spark, docs, texts):
    cut = repeats.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(texts)
    kept = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert kept[0] == "" and kept[25] == "one" and kept[22] == ""
    assert repeats.remove_repeats(empty(spark)).count() == 0
    twice = spark.createDataFrame([(None, "xy" * 150, "", "", 0, "")] * 2, DOCUMENT)
    assert [r["n_removed"] for r in repeats.digest(twice).collect()] == [300, 300]


# --- personal data ---------------------------------------------------------------------

_BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    for kind, pattern in _BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            yield kind, m.start(), m.end()


def test_base_spans_are_those_of_the_plain_patterns():
    rng = random.Random(9)
    parts = ["a.b@c.de", "x@y", "@", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+49 (30) 123-4567", ".", " ", "é", "9", "-", "+1"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        found = [tuple(s)[:3] for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS]
        assert found == list(plain_spans(text)), text


def test_checksums_and_context():
    kinds = [s.kind for s in pii.find_spans("bank account DE89 3704 0044 0532 0130 00, ssn 078-05-1120, not DE00 3704 0044 0532 0130 00")]
    assert kinds == ["iban", "ssn"]
    assert not [s for s in pii.find_spans("part number 078-05-1120") if s.kind == "ssn"]
    assert pii.mask("mail a@b.de now", pii.find_spans("mail a@b.de now")) == "mail [EMAIL] now"


def test_personal_data_of_whole_tables(spark, docs, texts):
    assert pii.digest(docs).count() == len(texts)
    rows = [(1, None, "", "", 0, ""), (None, "a@b.de " * 3 + "1" * 20_000, "", "", 0, "")]
    found = pii.digest(spark.createDataFrame(rows, DOCUMENT)).orderBy("doc_id").collect()
    assert [r["n_email"] for r in found] == [3, 0]
    masked = pii.mask_documents(spark.createDataFrame(rows, DOCUMENT)).orderBy("doc_id").collect()
    assert "@" not in masked[0]["text"] and masked[1]["text"] is None
    assert pii.digest(empty(spark)).count() == 0


# --- tokens ----------------------------------------------------------------------------

BYTE_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABETS = ["a ", "ab \n", "=-_ ", "aaa  \t\n'st", "éèÜ ßñ漢字ก😀́ \x1c\x85a1Σσ", "0123456789 .,", "".join(map(chr, range(32, 127)))]


def random_texts(seed, count):
    rng = random.Random(seed)
    for i in range(count):
        alphabet = rng.choice(ALPHABETS)
        repeat = rng.randrange(1, 20) if i % 3 == 0 else 1
        yield "".join(rng.choice(alphabet) * repeat for _ in range(rng.randrange(40)))


def test_byte_ids_are_those_of_the_rank_library():
    coder = byte_bpe.ByteBpe(BYTE_PATH, public_tokenizers.PATTERN)
    ranks = byte_bpe.read_ranks(BYTE_PATH)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in random_texts(1, 6000):
        ids = coder.encode(text).tolist()
        assert ids == other.encode_ordinary(text), repr(text)
        assert coder.decode(ids) == text.encode()
    ids, places = coder.encode_with_offsets("a漢😀 b")
    assert "".join(dict.fromkeys("a漢😀 b"[a:b] for a, b in places)) == "a漢😀 b"
    assert coder.decode_text(ids[:2]).startswith("a")


def test_byte_tokens_of_whole_tables(spark, docs, texts):
    found = {r["doc_id"]: r for r in byte_bpe.digest(docs, BYTE_PATH, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        assert found[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert found[23]["n_tokens"] == 0
    both = byte_bpe.encode_documents(docs, BYTE_PATH, public_tokenizers.PATTERN, offsets=True).collect()
    assert all(len(r["ids"]) == len(r["starts"]) == len(r["ends"]) for r in both)


def test_word_ids_are_those_of_the_tokenizer():
    words, plain = packing.WordTokens(WORD_PATH), Tokenizer.from_file(WORD_PATH)
    for text in random_texts(2, 4000):
        assert np.frombuffer(words.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_covers_every_id_once(spark, docs, texts):
    plain = Tokenizer.from_file(WORD_PATH)
    rows = packing.pack_documents(docs, WORD_PATH, capacity=256).collect()
    ids = {i: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in enumerate(texts)}
    places, pieces = Counter(), {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        places[r["doc_id"]] += r["length"]
        pieces.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert places == {i: len(x) for i, x in ids.items()}
    for parts in pieces.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    assert packing.pack_documents(empty(spark), WORD_PATH).count() == 0


@pytest.mark.parametrize("histogram", [{1: 3, 4096: 2, 2048: 5}, {5: 1000, 3000: 7}, {n: n % 7 + 1 for n in range(1, 4097, 3)}, {}])
def test_plan_places_every_length(histogram):
    slots = packing.plan(histogram)
    placed = Counter()
    for s in slots:
        placed[s.length] += s.count
        assert s.offset + s.length <= packing.CAPACITY
    assert placed == histogram


# --- quality ---------------------------------------------------------------------------


def test_classifier_learns_from_other_rows_than_it_is_tested_on(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(documents, labels)
    scored = quality.judge(quality.score_documents(documents, model)).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in scored)
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.9


def test_classifier_on_hard_rows(spark, docs, texts):
    model = quality.fit(["good words here", "bad bad bad bad"] * 20, [1, 0] * 20)
    rows = quality.judge(quality.score_documents(docs, model)).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    alone = quality.fit(["x"] * 8, [1] * 8)
    assert alone.score("") == pytest.approx(0.9) and quality.fit([], []).score("x") == pytest.approx(0.5)
    assert quality.keep_good(empty(spark), model).count() == 0


# --- archives --------------------------------------------------------------------------


def test_archives_give_back_what_was_written(spark):
    big = "<p>ä</p>" * 30
    rows = [(1, "http://a/", big), (2, "http://b/", big), (3, "http://c/", "small"), (4, "http://d/", "small"), (5, None, None), (6, "http://e/ x", big + "!")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    found = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    for page_id, _, html in rows:
        data = (html or "").encode()
        assert found[page_id]["payload_bytes"] == len(data)
        assert found[page_id]["payload_digest"] == hashlib.sha256(data).hexdigest()
    assert {i: r["refers_to"] for i, r in found.items()} == {1: None, 2: 1, 3: None, 4: None, 5: None, 6: None}
    assert found[2]["record_type"] == "revisit"
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_byte_ranges_join_neighbours(spark):
    index = spark.createDataFrame([("f", 0, 10), ("f", 10, 5), ("f", 500, 5), ("g", 3, 4)], "file string, offset bigint, length bigint")
    found = sorted((r["file"], r["start"], r["end"], len(r["records"])) for r in warc.byte_ranges(index, gap=50).collect())
    assert found == [("f", 0, 15, 2), ("f", 500, 505, 1), ("g", 3, 7, 1)]


# --- URLs ------------------------------------------------------------------------------


def test_urls_and_rules(spark):
    urls = ["http://A.Example.NET/en/x?q#f", "https://example.net", "x.net/", None, "ftp://b.example.com/de/", "http://c.org/fr/1?x", "http://notnet/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    outcomes = spark.createDataFrame([(6, 0), (6, None)], "page_id bigint, bad int")
    found = {r["page_id"]: r for r in url_filters.judge_urls(pages, outcomes).collect()}
    assert [found[i]["host"] for i in range(7)] == ["a.example.net", "example.net", "", "", "b.example.com", "c.org", "notnet"]
    assert [found[i]["path"] for i in range(7)] == ["/en/x", "", "", "", "/de/", "/fr/1", "/"]
    assert [found[i]["rule"] for i in range(7)] == ["example.net/en/", None, None, None, "example.com/de/", "org/fr/", None]
    assert found[0]["verdict"] == "allow" and found[4]["verdict"] == "block"
    assert url_filters.judge_urls(pages.limit(0), outcomes).count() == 0


def test_hosts_shrink_to_their_domain(spark):
    counts = [("bad.x.com", 9, 10), ("new.x.com", 0, 0), ("ok.y.com", 0, 50), ("new.y.com", 0, 0)]
    rates = {r["host"]: r["rate"] for r in url_filters.host_reputation(spark.createDataFrame(counts, "host string, bad int, seen int")).collect()}
    assert rates["bad.x.com"] > rates["new.x.com"] > rates["new.y.com"] > rates["ok.y.com"]


# --- fingerprints ----------------------------------------------------------------------


def test_fingerprints_of_edited_texts(docs, texts):
    rows = {r["doc_id"]: r for r in fingerprints.compare_edited(docs).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        own, following = t or "", texts[(i + 1) % len(texts)] or ""
        quarter = len(own) // 4
        edited = own[: len(own) - quarter] + following[:quarter]
        assert rows[i]["n_chars"] == len(own)
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if edited == own:
            assert rows[i]["edited_fingerprint"] == rows[i]["fingerprint"] and rows[i]["near_edited"] == 1
    assert rows[0]["near_next"] == 1 and rows[0]["fingerprint"] == rows[1]["fingerprint"]


def test_sketches_estimate_and_merge(spark):
    words = [f"w{i}" for i in range(3000)]
    a, b = words[:2000], words[1000:]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string")
    sk = df.select(fingerprints.sketch(df.a).alias("a"), fingerprints.sketch(df.b).alias("b"))
    row = sk.select(
        fingerprints.resemblance(sk.a, sk.b).alias("r"), fingerprints.containment(sk.a, sk.b).alias("c"), fingerprints.distinct_shingles(sk.a).alias("n")
    ).first()
    assert row["r"] == pytest.approx(1 / 3, abs=0.15) and row["c"] == pytest.approx(0.5, abs=0.2)
    assert row["n"] == pytest.approx(1996, rel=0.3)
    parts = spark.createDataFrame([(1, " ".join(a)), (1, " ".join(b))], "doc_id bigint, text string")
    merged = fingerprints.merge_parts(fingerprints.sketch_documents(parts), "doc_id").first()["sketch"]
    assert merged == sorted(set(sk.first()["a"]) | set(sk.first()["b"]))[: fingerprints.SKETCH_SIZE]


def test_fingerprints_of_hard_rows(spark):
    one = spark.createDataFrame([(4, "a b c d e f g h")], "doc_id bigint, text string")
    row = fingerprints.compare_edited(one).first()
    assert row["near_next"] == 1 and row["n_chars"] == 15
    odd = spark.createDataFrame([(None, "x"), (None, None), (1, "y"), (1, "y")], "doc_id bigint, text string")
    assert fingerprints.compare_edited(odd).count() == 4
    assert fingerprints.compare_edited(empty(spark)).count() == 0


# --- nearest neighbours ----------------------------------------------------------------


def test_recall_of_nearest_neighbours(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["vec"]) for r in nearest.usable(df).collect()}
    ids = np.array(sorted(rows))
    vectors = np.stack([rows[i] for i in ids])
    hits = total = 0
    found = {}
    for r in nearest.search(df, settings=nearest.Search(vectors_per_block=4000)).collect():
        found.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    for q in ids[ids % 100 == 0]:
        distance = np.sqrt(((vectors - rows[q]) ** 2).sum(axis=1))
        best = [i for i in ids[np.lexsort((ids, distance))] if i != q][:10]
        hits, total = hits + len(set(best) & set(found[q])), total + len(best)
        assert all(s == pytest.approx(np.linalg.norm(rows[q] - rows[v]), abs=1e-12) for v, s in found[q].items())
    assert hits / total >= 0.9


def test_nearest_neighbours_of_hard_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [1.0, 1.0]), (7, [1.0, 0.0]), (None, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest.search(df).orderBy("rank").collect()]
    assert found == [(0, 1, 1, 0.0), (0, 2, 7, 0.0), (0, 3, 6, 1.0)]
    assert nearest.search(df.limit(0)).count() == 0


@pytest.mark.parametrize("like", [ngram_join.Likeness(), ngram_join.Likeness(words=5, share=80)])
def test_linked_sets_share_a_block(like):
    rng = np.random.default_rng(3)
    linked = 0
    for size in rng.integers(1, 300, 1500).tolist():
        one = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        changed = int(rng.integers(0, size // 4 + 2))
        kept = rng.permutation(one)[: max(len(one) - int(rng.integers(0, changed + 1)), 1)]
        other = np.unique(np.concatenate([kept, rng.integers(0, 1 << 64, changed // 2, dtype=np.uint64)]))
        shared, sizes = len(np.intersect1d(one, other)), len(one) + len(other)
        if like.linked(np.int64(shared), np.int64(sizes)):
            linked += 1
            assert len(np.intersect1d(ngram_join.block_keys(one, like), ngram_join.block_keys(other, like)))
    assert linked > 100


@pytest.mark.parametrize("like", [ngram_join.Likeness(), ngram_join.Likeness(words=5, share=80)])
def test_linked_sets_of_any_two_sizes_share_a_block(like):
    rng = np.random.default_rng(5)
    for small in range(1, 150):
        for large in range(small, small * like.share_of // like.share + 1):
            shared = int(like.least_overlap(np.int64(small + large)))  # as different as linked sets can be
            for _ in range(6):
                hashes = rng.integers(0, 1 << 64, small + large - shared, dtype=np.uint64)
                one, other = np.sort(hashes[:small]), np.sort(hashes[small - shared :])
                assert like.linked(np.int64(shared), np.int64(small + large)) and len(one) == small and len(other) == large
                assert len(np.intersect1d(ngram_join.block_keys(one, like), ngram_join.block_keys(other, like))), (small, large)


def test_repeated_rows_keep_their_near_copies(spark):
    rows = []
    for i in range(0, 16, 2):
        words = [f"w{i}x{j}" for j in range(100)]
        rows += [(i, " ".join(words)), (i + 1, " ".join([*words[:-1], "other"]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r["doc_id"], r["component_id"]) for r in ngram_join.linked_groups(df.union(df)).collect()}
    assert found == {(i, i // 2 * 2) for i in range(16)}
    some = df.union(df.filter("doc_id % 4 < 1"))
    found = {(r["doc_id"], r["component_id"]) for r in ngram_join.linked_groups(some).collect()}
    assert found == {(i, i // 2 * 2) for i in range(16)}


def test_a_document_of_several_texts_joins_their_groups(spark):
    rows = [(0, "a b c d"), (1, "k l m n"), (2, "a b c d"), (2, "k l m n"), (3, "q r s t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.linked_groups(df).collect())
    assert found == [(0, 0), (1, 0), (2, 0), (2, 0), (3, 3)]


def test_recall_of_nearest_neighbours_with_default_blocks(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["vec"]) for r in nearest.usable(df).collect()}
    ids = np.array(sorted(rows))
    vectors = np.stack([rows[i] for i in ids])
    found = {(r["query_id"], r["vec_id"]) for r in nearest.search(df).collect()}
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        distance = np.sqrt(((vectors - rows[q]) ** 2).sum(axis=1))
        best = [i for i in ids[np.lexsort((ids, distance))] if i != q][:10]
        hits, total = hits + sum((q, i) in found for i in best), total + len(best)
    assert hits / total >= 0.9


def test_every_window_belongs_to_its_leftmost_smallest_gram():
    rng = np.random.default_rng(3)
    for trial in range(200):
        size = int(rng.choice([0, 199, 200, 201, 260, 700]))
        data = bytes(rng.integers(97, 97 + int(rng.choice([1, 2, 26])), size).astype(np.uint8))
        if trial % 3 == 0:
            data = (data[: int(rng.integers(1, 60))] * size)[:size]
        owners = {}
        places, _, _, room = repeats.anchors(data)
        for place, bytes_around in zip(places.tolist(), room.tolist()):
            before, after = bytes_around >> 16, bytes_around & 0xFFFF
            for start in range(place - before, place + after - repeats.THRESHOLD + 1):
                assert start not in owners
                owners[start] = place
        wanted = {}
        if size >= repeats.THRESHOLD:
            grams = repeats.Fingerprints(data).every(repeats.GRAM).tolist()
            for start in range(size - repeats.THRESHOLD + 1):
                window = grams[start : start + repeats.THRESHOLD - repeats.GRAM + 1]
                wanted[start] = start + window.index(min(window))
        assert owners == wanted


def test_points_come_back_as_they_were():
    rng = np.random.default_rng(8)
    points = [ngram_join.point(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)) for n in (0, 1, 100, 200_000)]
    back = ngram_join.unpacked_points([ngram_join.packed_point(p) for p in points])
    assert (back == np.stack(points)).all() and back.sum(axis=1).tolist() == [0, 1, 100, 200_000]
