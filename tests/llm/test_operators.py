"""Operators against brute-force versions, exact round trips and held-out accuracy, and on awkward tables."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from codetree.llm import compact_windows, components, dac, host_rank, jaccard_join, kneser_ney, language_id, latent, packing
from codetree.llm import queries, token_ids, winnowing, words, wrapper

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, vocabulary=4_000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(9)}" for _ in range(n))


SHARED = prose(1, 70)
LONG = prose(2, 40_000)
AWKWARD = [
    (1, "A b c d e f g.", "en", "s", 14),
    (2, None, "en", "s", None),
    (3, "", None, "s", 0),
    (4, " \n\t ", "de", None, 4),
    (5, f"{prose(3, 90)} {SHARED} {prose(4, 60)}", "en", "s", 0),
    (6, f"{prose(5, 30)} {SHARED} {prose(6, 80)}", "en", "s", 0),
    (7, LONG, "en", "s", 0),
    (8, LONG, "en", "s", 0),
    (9, "12 34 !!", "fr", "s", 8),
    (9, "12 34 !!", "fr", "s", 8),
    (10, "Éa ñu 中文 \U0001f600 <|endoftext|> don't", "fr", "s", 1),
    (None, "no id here at all", None, None, 1),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def awkward(spark):
    queries.ready(spark)
    more = ["id string", "key string", "kept string", "own_id string", "spans string", "text_in string", "hub string"]
    rows = [(*r, *["x"] * len(more)) for r in AWKWARD]
    return spark.createDataFrame(rows, f"{DOCS}, {', '.join(more)}").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    queries.ready(spark)
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return queries.ready(spark).read.parquet(f"{SF}/documents.parquet")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# Language identification


def test_languages_of_held_out_documents(spark):
    found = queries.op1_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    kept = found.filter("held_out").join(truth, "doc_id")
    assert kept.count() > 100
    assert kept.filter("lang = lang_pred").count() >= 0.98 * kept.count()
    assert found.filter("score < 0 or score > 1").count() == 0


def test_language_of_awkward_texts(awkward, empty):
    found = by_id(language_id.identify(awkward, language_id.train(awkward)))
    assert found[2]["lang_pred"] == found[3]["lang_pred"] == found[4]["lang_pred"] == found[9]["lang_pred"] == "und"
    assert found[2]["score"] == 0 and found[7]["lang_pred"] == "en" and found[7]["text_in"] == "x"
    none = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.identify(awkward, none).collect()} == {"und"}
    assert language_id.identify(empty, language_id.train(awkward)).count() == 0


def test_prediction_does_not_depend_on_neighbours():
    model = language_id.LanguageModel(["a", "b"], np.log([0.5, 0.5]), np.random.default_rng(0).normal(size=(2, 1 << 16)).astype(np.float32), 16)
    texts = ["one two", "", "Zwei, drei", "é"]
    alone = [language_id._score([t], model) for t in texts]
    names, scores = language_id._score(texts, model)
    assert names == [a[0][0] for a in alone] and np.allclose(scores, [a[1][0] for a in alone])


# Jaccard join


def shingle_set(text, width):
    own = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        own = own.replace(c, " ")
    own = [w for w in own.split(" ") if w]
    return frozenset([tuple(own[i : i + width]) for i in range(len(own) - width + 1)] or ([tuple(own)] if own else []))


def brute_components(texts, width, num, den):
    sets = {k: shingle_set(t, width) for k, t in texts.items()}
    up = {k: k for k in sets}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                    low, high = sorted((top(a), top(b)))
                    up[high] = low
    return {k: (len(sets[k]), top(k)) for k in keys}


@pytest.mark.parametrize(("width", "num", "den"), [(4, 85, 100), (5, 80, 100), (1, 1, 2)])
def test_jaccard_components(spark, monkeypatch, width, num, den):
    monkeypatch.setattr(jaccard_join, "CHUNK_GRAMS", 300)  # several chunks per block
    rng, texts = random.Random(width), {}
    for base in range(12):
        own = prose(base, rng.choice([3, 5, 6, 7, 8, 20, 60])).split()
        for copy in range(9):
            changed = list(own)
            for _ in range(copy // 2):
                changed[rng.randrange(len(changed))] = f"n{rng.random()}"
            texts[100 * base + copy] = " ".join(changed)
    texts |= {5_000: "", 5_001: None, 5_002: " ", 5_003: "One", 5_004: "oNE"}
    found = by_id(jaccard_join.jaccard_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), width=width, num=num, den=den))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in found.items()} == brute_components(texts, width, num, den)


def test_a_set_of_many_near_copies_is_not_moved_to_all_their_blocks(spark, monkeypatch):
    base, rng, rows = prose(31, 400).split(), random.Random(7), []
    for i in range(60):
        own = list(base)
        for at in rng.sample(range(0, 400, 33), 3):
            own[at] = "changed"
        rows.append((i, " ".join(own)))
    moved, links = [], jaccard_join._block_links
    monkeypatch.setattr(jaccard_join, "_block_links", lambda df, *more: moved.append(df.count()) or links(df, *more))
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in out} == {0}
    assert sum(moved) < 4 * len(rows)


def test_jaccard_on_awkward_tables(awkward, empty):
    found = jaccard_join.jaccard_components(awkward).collect()
    assert len(found) == len(AWKWARD)
    assert {r["component_id"] for r in found if r["doc_id"] in (7, 8)} == {7}
    assert jaccard_join.jaccard_components(empty).count() == 0
    kept = jaccard_join.keep_one_per_component(awkward)
    assert kept.columns == awkward.columns and 8 not in by_id(kept) and kept.count() == len(AWKWARD) - 1


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7), (None, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 99: 99, 100: 99}


# Fingerprints


def brute_winnow(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    own = text.lower()
    for c in "\t\n\x0b\x0c\r":
        own = own.replace(c, " ")
    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in own.split(" ") if w]

    def together(part):
        seed = 42
        for h in part:
            seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed=seed)
        return seed

    grams = [together(hashes[i : i + gram]) >> 32 for i in range(max(1, len(hashes) - gram + 1))] if hashes else []
    kept = []
    for low in range(max(1, len(grams) - window + 1) if grams else 0):
        part = grams[low : low + window]
        place = low + max(i for i, g in enumerate(part) if g == min(part))
        if not kept or kept[-1] != place:
            kept.append(place)
    return " ".join(f"{p}:{grams[p]:x}" for p in kept)


def test_fingerprints(documents, spark):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()] + [(-1, ""), (-2, None), (-3, "Two words"), (-4, prose(9, 25))]
    found = by_id(winnowing.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    ordered = sorted(((k, t or "") for k, t in rows), reverse=True)
    for (k, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert found[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert found[k]["n_chars"] == len(text)
        assert found[k]["fingerprint"] == brute_winnow(text) and found[k]["edited_fingerprint"] == brute_winnow(edited)
        sets = [{e.split(":")[1] for e in brute_winnow(t).split()} for t in (text, edited, following)]
        for name, other in (("near_edited", sets[1]), ("near_next", sets[2])):
            either = sets[0] | other
            assert found[k][name] == pytest.approx(len(sets[0] & other) / len(either) if either else 1.0)


def test_shared_words_leave_a_common_entry():
    entries = [{e.split(":")[1] for e in brute_winnow(f"{a} {SHARED} {b}").split()} for a, b in ((prose(1, 9), "x"), ("y z", prose(2, 30)))]
    assert entries[0] & entries[1]


def test_fingerprints_of_awkward_tables(awkward, empty):
    found = winnowing.fingerprints(awkward)
    assert found.count() == len(AWKWARD) and by_id(found)[2]["fingerprint"] == ""
    assert winnowing.fingerprints(empty).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Quality


def test_probabilities_add_up(awkward, empty):
    model = np.exp(kneser_ney.train(awkward).astype(np.float64)).reshape(-1, kneser_ney.SYMBOLS)
    assert np.allclose(model.sum(axis=1), 1, atol=1e-4)
    assert np.allclose(np.exp(kneser_ney.train(empty)), 1 / kneser_ney.SYMBOLS)


def test_runs_are_of_one_text_each():
    alone = [kneser_ney.runs([t])[0] for t in ("abc", "", "x y")]
    number, first = kneser_ney.runs(["abc", "", "x y"])
    assert [number[a:b].tolist() for a, b in zip(first, first[1:])] == [x.tolist() for x in alone]


def test_quality_labels(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = kneser_ney.classify(documents, labels).join(labels, "doc_id")
    kept = {(r["quality"], r["keep"]): r["count"] for r in found.groupBy("quality", "keep").count().collect()}
    assert kept[1, True] >= 0.97 * (kept[1, True] + kept.get((1, False), 0))
    assert kept[0, False] >= 0.6 * (kept.get((0, True), 0) + kept[0, False])


def test_quality_tells_unfolded_characters_apart(spark):
    """Characters of one class (here code points six apart, and case) are different characters to the model."""
    good = "молоко и хлеб на столе " * 20
    other = "".join(chr(ord(c) + 6) if c != " " else c for c in good)
    rows = [(1, good, "ru"), (2, other, "ru"), (3, good.upper(), "ru"), (4, "milk and bread " * 20, "en"), (5, "MILK AND BREAD " * 20, "en"), (6, None, "en"), (7, "", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    found = by_id(kneser_ney.classify(df, labels))
    assert found[2]["perplexity"] > 2 * found[1]["perplexity"] and found[3]["perplexity"] > 2 * found[1]["perplexity"]
    assert found[5]["perplexity"] > 2 * found[4]["perplexity"]
    assert {n for n, r in found.items() if r["keep"]} >= {1, 4} and not {2, 3, 5, 6} & {n for n, r in found.items() if r["keep"]}


def test_plain_probabilities_add_up(spark):
    """Over all characters that can follow a context, seen or not."""
    df = spark.createDataFrame([("abab cab",), ("ba",), ("é",)], "text string")
    counts = kneser_ney._counts(df, "text")
    context, _, _ = kneser_ney.plain_runs(["ab", "xyz", "éa"])
    pairs = spark.createDataFrame([(int(c),) for c in set(context.tolist())], "context long").crossJoin(spark.range(300).select(F.col("id").alias("symbol")))
    sums = kneser_ney._scored(pairs, counts).groupBy("context").agg(F.sum("share").alias("share"), F.min("rest").alias("rest")).collect()
    assert sums and all(abs(r["share"] + r["rest"] - 1) < 1e-9 for r in sums)


def test_quality_of_awkward_tables(spark, awkward, empty):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 1), (2, 1, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    found = kneser_ney.classify(awkward, labels).collect()
    assert len(found) == len(AWKWARD) and all(not r["keep"] for r in found if r["doc_id"] == 2)
    assert kneser_ney.classify(empty, labels).count() == 0
    assert kneser_ney.classify(awkward, labels.limit(0)).count() == len(AWKWARD)


# Substring dedup


def test_windows_are_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(3)
    for _ in range(60):
        hashes = rng.integers(1, 30, rng.integers(1, 60)).astype(np.uint64)
        least, n = int(rng.integers(1, 12)), len(hashes)
        places = compact_windows.centres(hashes, np.array([0, n]), least)
        left, right = compact_windows.windows(hashes, places, 0, n)
        got = {(a, c, b) for a, c, b in zip(left.tolist(), places.tolist(), right.tolist()) if b - a + 1 >= least}
        want = set()
        for c in range(n):
            a = max([i + 1 for i in range(c) if hashes[i] <= hashes[c]], default=0)
            b = min([i - 1 for i in range(c + 1, n) if hashes[i] < hashes[c]], default=n - 1)
            if b - a + 1 >= least:
                want.add((a, c, b))
        assert got == want


def test_repeated_passages(spark, awkward, empty):
    edited = SHARED.split()
    edited[40] = "changed"
    more = spark.createDataFrame([(20, f"{prose(31, 100)} {' '.join(edited)} {prose(32, 100)}"), (21, prose(33, 300)), (22, prose(34, 49))], "doc_id long, text string")
    both = awkward.select("doc_id", "text").unionByName(more).withColumn("n_chars", F.length("text").cast("long"))
    found = compact_windows.repeats(both)
    rows = {(r["doc_id"], r["other_doc_id"]): r for r in found.collect()}
    assert {a for a, _ in rows} == {6, 8, 20}
    assert (rows[6, 5]["start_word"], rows[6, 5]["end_word"]) == (30, 100) and rows[6, 5]["similarity"] == 1
    assert 0.8 <= rows[20, 5]["similarity"] < 1 and (rows[20, 5]["start_word"], rows[20, 5]["end_word"]) == (100, 170)
    kept = {r["doc_id"]: r for r in compact_windows.cut_repeats(both, found).collect()}
    assert kept[6]["text"] == f"{prose(5, 30)} {prose(6, 80)}" and kept[6]["n_chars"] == len(kept[6]["text"])
    assert 8 not in kept and kept[21]["text"] == prose(33, 300) and kept[5]["text"] == AWKWARD[4][1]
    assert compact_windows.repeats(empty).count() == 0
    cut = compact_windows.cut_repeats(awkward, compact_windows.repeats(awkward))
    assert cut.columns == awkward.columns and cut.count() == len(AWKWARD) - 1


def test_a_long_copy_with_many_insertions_is_one_repeat():
    rng = np.random.default_rng(11)
    source = rng.integers(0, 1 << 16, 3_000).astype("<u2")
    copy = np.insert(source, np.arange(60, 3_000, 60), 7)  # 49 words put in
    a, b = compact_windows._shingled(copy), compact_windows._shingled(source)
    seeds = [(i + i // 60, i, i // 30 % 3) for i in range(20, 2_980, 30) if i % 60 < 56]
    found = compact_windows.passages(a, b, seeds, 46, 2, 0.8)
    covered = np.zeros(len(a), bool)
    for start, end, *_ in found:
        covered[start : end + 1] = True
    assert covered.mean() > 0.95


def test_a_repeat_is_found_past_documents_that_share_only_a_line_of_it(spark):
    line = prose(70, 42)
    passage = f"{prose(742, 6)} {line} {prose(743, 6)}"  # all six centres lie in the line
    rows = [(i, f"{prose(100 + i, 80)} {line} {prose(200 + i, 80)}") for i in range(1, 60)]
    rows += [(0, f"{prose(73, 80)} {line} {prose(74, 80)}"), (5, f"{prose(75, 90)} {passage} {prose(76, 90)}")]
    rows = [r for r in rows if r != rows[4]] + [(70, f"{prose(77, 60)} {passage} {prose(78, 60)}")]
    found = compact_windows.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["other_doc_id"], r["start_word"], r["end_word"]) for r in found} == {(70, 5, 60, 114)}


# Token files


def test_token_ids_are_the_library_s():
    tokenizer = token_ids.TokenIds(queries.tokenizer_path())
    assert tokenizer.by_word
    rng = random.Random(5)
    letters = "abcXYZ's't 're\n\t\xa0\x85\x1c\x1f\xad ²³½ªºµßÀÿ×÷.,!?<|endoftext|>0123éèüñ€ΣσςİıǺﬁ中文\U0001f600  -_#$%&"
    for i in range(1_500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(30))) + " <|endoftext|> don't I'LL we're" * (i % 7 == 0)
        assert tokenizer.encode(text).tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65_535, 65_536, 2**32 - 1], list(range(0, 70_000, 7))])
def test_directly_addressable_codes(values):
    ids = np.array(values, np.uint64)
    segment = dac.Segment(dac.encode(ids))
    assert len(segment) == len(values) and segment.all().tolist() == values
    places = np.random.default_rng(1).permutation(len(values))
    assert segment.at(places).tolist() == ids[places].tolist()


def test_token_files(spark, awkward, empty, tmp_path, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT_TOKENS", 1_000)
    path, tokenizer = str(tmp_path / "files"), queries.tokenizer_path()
    dac.write_token_files(awkward, path, tokenizer, end=1)
    found = sorted(dac.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    library = token_ids.TokenIds(tokenizer).tokenizer
    order = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for row, (name, text, *_) in zip(found, order, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert tuple(row) == (name, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    wanted = spark.createDataFrame([(7, 12_345), (7, 10**9), (1, 0), (77, 0)], "doc_id long, place long")
    read = {(r["doc_id"], r["place"]): r["token"] for r in dac.read_tokens(spark, path, wanted).collect()}
    assert read == {(7, 12_345): library.encode(LONG, add_special_tokens=False).ids[12_345], (7, 10**9): None, (1, 0): library.encode("A").ids[0]}
    dac.write_token_files(empty, str(tmp_path / "none"), tokenizer, end=1)
    assert dac.read_token_files(spark, str(tmp_path / "none")).count() == 0


# Decontamination


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(15))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert latent.common_subsequence(a, b) == table[-1][-1]


def test_leaks(spark, documents, empty, awkward):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    changed = items[3].split()
    changed[5], changed[9] = "other", "words"
    planted = {9_001: f"{prose(1, 200)} {items[0]} {prose(2, 50)}", 9_002: f"{prose(3, 33)} {' '.join(changed)}", 9_003: prose(4, 500), 9_004: items[7].upper()}
    rows = spark.createDataFrame([*texts.items(), *planted.items()], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in latent.leaks(rows, benchmark).collect()}
    assert {(9_001, 0), (9_002, 3), (9_004, 7)} <= found and 9_003 not in {d for d, _ in found}
    whole = {(d, i) for d, t in texts.items() for i, item in items.items() if " ".join(item.split()) in " ".join(t.split())}
    assert len(whole & found) >= 0.9 * len(whole)
    assert latent.leaks(empty, benchmark).count() == 0 and latent.leaks(rows, benchmark.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (2, "A b c d e f g."), (None, "zzz")], "item_id long, text string")
    hits = latent.leaks(awkward, odd)
    assert (1, 2) in {(r["doc_id"], r["item_id"]) for r in hits.collect()}
    left = latent.without_leaks(awkward, hits)
    assert left.columns == awkward.columns and 1 not in by_id(left) and left.filter("doc_id is null").count() == 2


def test_the_space_is_fitted_on_all_documents(spark, monkeypatch):
    fitted, fit = [], latent.latent_space
    monkeypatch.setattr(latent, "latent_space", lambda rows, *rest: fitted.append(rows.count()) or fit(rows, *rest))
    rows = spark.range(20_500).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c "), F.col("id")).alias("text"))
    benchmark = spark.createDataFrame([(1, "a b c 7 8 9 10.")], "item_id long, text string")
    latent.leaks(rows, benchmark)
    assert fitted == [20_500]


def test_a_leak_is_found_beside_a_repeated_term_and_without_its_rare_words(spark):
    common = ["the", "of", "and", "to", "in", "is", "for", "on", "that", "by", "with", "as"]
    rare = [f"rare{i}" for i in range(5)]
    items = {1: " ".join(prose(90, 15).split()), 2: " ".join(common * 2 + rare)}
    first = items[1].split()[0]
    docs = {i: " ".join(common) + " " + prose(300 + i, 60) for i in range(200)}
    docs[500] = f"{items[1]} {' '.join([first] * 45)}"
    docs[501] = f"{prose(91, 20)} {' '.join(common * 2 + ['other'] * 5)} {prose(92, 20)}"
    found = latent.leaks(spark.createDataFrame([*docs.items()], "doc_id long, text string"), spark.createDataFrame([*items.items()], "item_id long, text string"))
    assert {(500, 1), (501, 2)} <= {(r["doc_id"], r["item_id"]) for r in found.collect()}


# URL filter


def test_rules_and_ranks(spark):
    links = [("good.org", "a.net"), ("good.org", "a.net"), ("a.net", "b.net"), ("c.net", "bad.example.com"), ("b.net", "c.net")]
    pages, sources = [], {}
    for src, dst in links:
        sources.setdefault(src, []).append(f'<a class=x href="https://{dst.upper()}/p?q">x</a><a href="/here">y</a>')
    urls = {"good.org": "http://good.org/", "bad.example.com": "https://Bad.example.com/de/1?x#y"}
    for i, host in enumerate(["good.org", "a.net", "b.net", "c.net", "bad.example.com"]):
        pages.append((i, urls.get(host, f"http://{host}/x"), "".join(sources.get(host, []))))
    pages += [(10, None, None), (11, "no scheme", ""), (12, "http://x.example.org/es/z", None), (13, "ftp://x.example.org/en/12#a", None),
              (14, "http://example.org?x", None), (14, "http://example.org?x", None), (None, "http://notorg/es/", "<a href=//c.net>")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("trust", F.lit("x"))
    found = {r["page_id"]: r for r in host_rank.judge(table, queries.RULES).collect()}
    parts = {k: (r["host"], r["path"], r["rule"]) for k, r in found.items()}
    assert parts[4] == ("bad.example.com", "/de/1", "com/de/") and parts[0] == ("good.org", "/", "org/")
    assert parts[10] == parts[11] == ("", "", None) and parts[12][2] == "example.org/es/" and parts[13][2] == "example.org/en/1"
    assert parts[14] == ("example.org", "", None)
    assert [found[k]["verdict"] for k in (0, 4, 12, 13, 10)] == ["allow", "block", "block", "block", "allow"]

    weight = {}
    for r in host_rank.host_links(table.withColumn("host", host_rank.host_of(F.col("url")))).collect():
        weight[r["src"], r["dst"]] = r["n"]
    assert weight == {("good.org", "a.net"): 2, ("a.net", "b.net"): 1, ("c.net", "bad.example.com"): 1, ("b.net", "c.net"): 1, ("notorg", "c.net"): 1}
    hosts = sorted({h for pair in weight for h in pair} | {"x.example.org"})
    at = {h: i for i, h in enumerate(hosts)}
    forth, seeds = np.zeros((len(hosts),) * 2), np.zeros((2, len(hosts)))
    for (a, b), n in weight.items():
        forth[at[a], at[b]] = n
    seeds[0, at["good.org"]] = 1
    for h, n in (("bad.example.com", 1), ("x.example.org", 2)):
        seeds[1, at[h]] = n / 3
    for row, matrix in ((0, forth), (1, forth.T)):
        steps = matrix / np.maximum(matrix.sum(axis=1, keepdims=True), 1)
        rank = seeds[row].copy()
        for _ in range(host_rank.ROUNDS):
            rank = seeds[row] + host_rank.DAMPING * steps.T @ rank
        rank /= rank.sum()
        for k, r in found.items():
            if r["host"] in at and k is not None:
                assert r[("trust", "distrust")[row]] == pytest.approx(rank[at[r["host"]]])
    for r in found.values():
        if r["rule"] is None:
            share = r["distrust"] / max(r["trust"] + r["distrust"], 1e-300)
            assert r["verdict"] == ("block" if share > host_rank.BLOCK_SHARE else "allow")
    assert found[3]["distrust"] > found[1]["distrust"] and found[1]["trust"] > found[3]["trust"]


def test_url_filter_on_empty_table(spark):
    assert host_rank.judge(spark.createDataFrame([], "page_id long, url string, html string"), queries.RULES).count() == 0


# Main text


def test_main_text_of_a_site_without_article_elements(spark):
    page = '<html><body><div class="top">My site<br>since 1999</div><div><h2>{0}</h2><p>{1} &amp; more\n text<p>Second {1}</div><div>All rights reserved</div><div id="comments">I like {1}</div></body>'
    bodies = [page.format(f"Title {i}", f"body {i}") for i in range(4)]
    rows = [(i, f"http://h.net/{i}", b) for i, b in enumerate(bodies)] + [(9, "http://other.net/", bodies[0]), (10, None, None), (11, "http://h.net/x", ""), (11, "http://h.net/x", "")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refs", F.lit("x"))
    found = {r["page_id"]: r for r in wrapper.main_text(table).collect()}
    for i in range(4):
        assert found[i]["text"] == f"Title {i}\n\nbody {i} & more text\n\nSecond body {i}" and found[i]["n_chars"] == len(found[i]["text"])
    assert "My site since 1999" in found[9]["text"] and "I like" not in found[9]["text"]
    assert found[10]["text"] == found[11]["text"] == ""
    assert wrapper.main_text(table.limit(0)).count() == 0


def test_main_text_of_an_article():
    page = '<title>No</title><nav>No</nav><script>var t="</p>";</script><article><h1>Head</h1><p><b>One.<br><p>Two &lt;3</p><aside>No</aside><form>No</form><div class="ad">No</div></article><footer>No'
    assert wrapper.extract(page, []) == "Head\n\nOne.\n\nTwo <3"
    assert wrapper.extract("a < b <p", []) == "a < b <p" and wrapper.extract("<div>" * 5_000 + "deep", []) == "deep"


def test_what_is_skipped_ends_where_it_ends():
    for skipped in ('<svg class="i" d=">"/>', "<svg/>", "<math/>", "<title-bar>", "<template-x>", "<svg>", "<select>", "<title>", "<iframe src=x>"):
        assert wrapper.extract(f"<article><p>One.</p>{skipped}<p>Two.</p></article>", []) == "One.\n\nTwo.", skipped
    assert wrapper.extract("<p>One.<svg><title>No</title></svg><select><option>No</select><svg/><p>Two.<svg>No</svg>", []) == "One.\n\nTwo."
    assert wrapper.extract("<p>One.</p><script>No<p>No</p>", []) == "One."


# Packing


def test_packing(awkward, empty, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_PIECES", 400)
    pieces = packing.pieces(awkward, queries.tokenizer_path(), 0, 64)
    rows = packing.pack(pieces, capacity=64, block_pieces=5).collect()
    library = token_ids.TokenIds(queries.tokenizer_path()).tokenizer
    want = []
    for name, text, *_ in AWKWARD:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(name, at // 64, at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes())) for at in range(0, len(ids), 64)]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.pieces(empty, queries.tokenizer_path(), 0, 64)).count() == 0


def test_packing_is_near_the_bound():
    rng = random.Random(1)
    lengths = [rng.randrange(1, 900) for _ in range(3_000)]
    numbers = packing.evolve(lengths, 2_048, 1, [])
    fills = np.bincount(numbers, weights=lengths)
    assert fills.max() <= 2_048 and len(fills) <= 1.002 * sum(lengths) / 2_048 + 1


def test_crossover_keeps_every_item_once():
    rng = random.Random(4)
    lengths = [rng.randrange(1, 40) for _ in range(300)]
    a, b = packing.Bins(lengths, 64), packing.Bins(lengths, 64)
    a.place(range(300))
    b.place(sorted(range(300), key=lambda i: -lengths[i]))
    child = packing.crossover(a, b, rng)
    assert sorted(i for items in child.bins for i in items) == list(range(300))
    assert all(sum(lengths[i] for i in items) + room == 64 for items, room in zip(child.bins, child.room))


# Words


def test_words_and_shingles():
    texts = ["One  two\nthree", "", None, "\x0bA", "one TWO three four", "ÉA x"]
    found = words.cut_words(pa.array(texts, pa.string()))
    assert np.diff(found.first).tolist() == [3, 0, 0, 1, 4, 2]
    assert found.hash[0] == found.hash[4] and found.hash[1] == found.hash[5]
    assert [found.data[a:b].tobytes().decode() for a, b in zip(found.start, found.end)][:4] == ["One", "two", "three", "A"]
    grams, first, _ = words.shingles(found, 3)
    assert np.diff(first).tolist() == [1, 0, 0, 1, 2, 1] and grams[0] == grams[2]
    assert words.cut_words(pa.array([], pa.string())).first.tolist() == [0]
