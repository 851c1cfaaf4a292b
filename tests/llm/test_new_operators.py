"""Fill-in-the-middle, token alignment and secret scan against plain versions of their contracts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from codetree.llm import fill_middle, queries, secret_scan, token_alignment, words, wrapper
from tests.llm.test_operators import AWKWARD, DOCS, SF, awkward, documents, empty  # noqa: F401

A_PATH, B_PATH = (public_tokenizers.path(n) for n in queries.ALIGNED)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Fill in the middle


def brute_rearranged(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    form = "spm" if h4 % 100 < 20 else "psm"
    return len(units), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@pytest.mark.parametrize("block", [1, 2, 7, 1 << 20])
def test_rotations(monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    for seed in range(400):
        rng = random.Random(seed)
        text = "".join(rng.choice(["a", "Bc", " ", "é", "中", "\U0001f600", "\n", "1", "<P", ">", "S>"]) for _ in range(rng.randrange(40)))
        digest = sha(f"1:{seed}")
        found = fill_middle.rearrange_text(text.encode(), tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)))
        assert (found.n, found.form, found.prefix_chars, found.middle_chars, found.output.decode()) == brute_rearranged(seed, text)
        assert fill_middle.restore_text(found.output, found.form).decode() == text


def test_exchange_is_in_place(monkeypatch):
    monkeypatch.setattr(fill_middle, "BLOCK", 3)
    for low, cut, high in [(0, 0, 9), (0, 9, 9), (2, 5, 20), (1, 19, 20), (4, 4, 4)]:
        buffer = bytearray(range(20))
        want = buffer[:low] + buffer[cut:high] + buffer[low:cut] + buffer[high:]
        fill_middle.exchange(buffer, low, cut, high)
        assert buffer == want


def test_rearranged_rows(spark, awkward, empty):  # noqa: F811
    marked = [(50 + i, t, None, None, 0) for i, t in enumerate(["a<P>b", "x <S>", "<M>", "<P", "é" * 50, "a" * 3_000_000])]
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(marked, DOCS))
    docs = docs.withColumn("form", F.lit("x")).withColumn("output", F.lit("y")).withColumn("draws", F.lit(1))
    rows = fill_middle.restore(fill_middle.rearrange(docs)).collect()
    want = [(i, *brute_rearranged(i, t), t or "") for i, t, *_ in [*AWKWARD, *marked]]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert fill_middle.restore(fill_middle.rearrange(empty)).count() == 0


# Token alignment


def brute_alignment(texts):
    """Per text: ids, byte ranges and links by looking at all pairs of tokens; counts over all texts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    letters = token_alignment.byte_of_letter()
    out, count = [], Counter()
    for text in texts:
        if not text:
            out.append(None)
            continue
        a_ids, b_ids = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
        sides = []
        pieces = [b.id_to_piece(i) for i in b_ids]
        for parts in (
            [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids],
            [bytes.fromhex(p[3:5]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces],
        ):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            sides.append((b"".join(parts), [0, *ends[:-1]], ends))
        if any(s[0] != f" {text}".encode() for s in sides):
            out.append(None)
            continue
        (_, a_low, a_high), (_, b_low, b_high) = sides
        meet = (np.array(a_low)[:, None] < np.array(b_high)) & (np.array(b_low) < np.array(a_high)[:, None])
        links = [(a_ids[i], b_ids[j]) for i, j in np.argwhere(meet)]
        groups, low = [], [0, 0]
        for cut in sorted(set(a_high) & set(b_high)):
            high = [a_high.index(cut, low[0]) + 1, b_high.index(cut, low[1]) + 1]
            groups.append("|".join(",".join(map(str, ids[i:j])) for ids, i, j in zip((a_ids, b_ids), low, high)))
            low = high
        count.update(links)
        out.append((len(a_ids), len(b_ids), len(groups), links, ";".join(groups)))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(n, best.get(j, 0))
    return [
        (0, 0, 0, 0, 0, 0, "") if o is None else (*o[:3], len(o[3]), sum(count[x] == best[x[1]] for x in o[3]), sum(count[x] for x in o[3]), o[4])
        for o in out
    ]


ODD = [
    "a  b", "\n\n x\n  y \t\tz\n", " lead", "  two", "trail  ", "\ttab", "x \n y", "it's  's \n'll", "<s> <unk> </s> <|endoftext|> <0x41>", "ééé ÿ §",
    " ", "\n", "   ", "1 2  3\n\n\n4", "a\tb", "%$# ##\n#", "x\r\ny;\r", "a\x00b \x1f c\x85d", "▁under ▁", "中文 \U0001f600 ﬁ Å", "nb\xa0sp", "é ​　z",
]


@pytest.mark.parametrize("heavy", [0, 20, 1 << 18])
def test_alignment(spark, awkward, monkeypatch, heavy):  # noqa: F811
    monkeypatch.setattr(token_alignment, "HEAVY_PAIRS", heavy)
    monkeypatch.setattr(token_alignment, "HEAVY_SHARE", 5)
    monkeypatch.setattr(token_alignment, "HELD_PAIRS", 40)
    texts = [*ODD, *ODD[:5], *["the same text"] * 30, *["another one\n"] * 3, None, None, "", ""]
    rows = [(100 + i, t, None, None, 0) for i, t in enumerate(texts)] + [r for r in AWKWARD if not r[1] or len(r[1]) < 5_000]
    docs = queries.ready(spark).createDataFrame(rows, DOCS).withColumn("key", F.lit("x")).withColumn("n_a", F.lit(1)).withColumn("groups", F.lit(""))
    found = token_alignment.measures(docs.repartition(5), A_PATH, B_PATH).collect()
    want = [(r[0], *m) for r, m in zip(rows, brute_alignment([r[1] for r in rows]))]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_fast_encoder_is_the_library(spark):
    """Over all texts of sf0.01, odd ones, and random ones of pieces that merge in many ways."""
    own = token_alignment.aligner(A_PATH, B_PATH)
    assert own.fast is not None
    rng = random.Random(4)
    pieces = list(own.library.get_vocab())[:3_000:7] + ["'s", " ", "  ", "\n", "\t ", "é", "中", "<|endoftext|>", "\u3000", "\x1f", "\x85", "\u00a0", "１", "ⅷ"]
    texts = ["".join(rng.choice(pieces) for _ in range(40)) for _ in range(2_000)] + ODD
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r["text"]]
    for text in texts:
        assert own.a_ids(f" {text}").tolist() == own.library.encode(f" {text}", add_special_tokens=False).ids


def test_long_runs(spark):
    own = token_alignment.aligner(A_PATH, B_PATH)
    text = "ab" * 20_000 + " " * 3_000 + "c"
    assert token_alignment.may_have_long_run(text) and not token_alignment.may_have_long_run("some words " * 900)
    for i in range(0, 2_000, 111):
        assert token_alignment.may_have_long_run("a " * i + "x" * 1_000 + " b" * 50) and token_alignment.may_have_long_run("a " * i + "\n" * 1_000)
    assert own.a_ids(f" {text}").tolist() == own.library.encode(f" {text}", add_special_tokens=False).ids


def test_alignment_of_an_empty_table(empty):  # noqa: F811
    assert token_alignment.measures(empty, A_PATH, B_PATH).count() == 0


def test_registered_alignment_is_the_digest(spark, documents):  # noqa: F811
    found = {r["doc_id"]: r for r in queries.op12_token_alignment(spark, SF).collect()}
    rows = documents.select("doc_id", "text").collect()
    for r, want in zip(rows, brute_alignment([r["text"] for r in rows])):
        assert tuple(found[r["doc_id"]]) == (r["doc_id"], *want[:-1], sha(want[-1]) if want[-1] else "")


# Secret scan

LETTERS = "[A-Za-z0-9+/_.=-]"


def brute_base(text):
    """Spans by the patterns as they stand."""
    def either(word):
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)

    names = "|".join(map(either, ["password", "passwd", "secret", "token"])) + "|" + either("api") + "_?" + either("key")
    out = []
    for kind, pattern, least in (("assign", rf"({names})[\"']?\x20*[:=]\x20*[\"']?({LETTERS}+)", 8), ("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text or ""):
            if len(m.group(2) if kind == "assign" else m.group()) >= least:
                out.append((m.start(), ["assign", "access", "hex"].index(kind), kind, m.end()))
    return [f"{kind}:{low}:{high}" for low, _, kind, high in sorted(out)]


def key_of(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_base_spans(spark, documents):  # noqa: F811
    rng = random.Random(3)
    parts = ["token", "PassWord", "secret", "api_key", "APIKEY", " = ", ":", '"', "'", "=", "abc", "0123456789abcdef", "é", " ", "AKIA", "ABCDEFGH", "IJKL0", "\n", "ſecret", "toKen", "a1b2c3d4e5f6a7b8"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(500)] + [None, ""]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    docs = queries.ready(spark).createDataFrame(rows, DOCS).withColumn("spans", F.lit(1)).withColumn("base", F.lit(1)).withColumn("runs", F.lit(1))
    docs = docs.select("doc_id", "text").union(documents.select(-F.col("doc_id") - 1, "text"))
    truth = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = secret_scan.scan(docs).select("doc_id", secret_scan.spelled_spans("base").alias("base"), secret_scan.spelled_spans("spans").alias("spans")).collect()
    assert len(found) == len(truth)
    for r in found:
        assert r["base"] == ",".join(brute_base(truth[r["doc_id"]]))
        assert [s for s in r["spans"].split(",") if not s.startswith("random")] == (r["base"].split(",") if r["base"] else [""][: not r["spans"]])


def test_registered_scan_counts(spark, documents):  # noqa: F811
    truth = {r["doc_id"]: brute_base(r["text"]) for r in documents.collect()}
    for r in queries.op13_secret_scan(spark, SF).collect():
        base = truth[r["doc_id"]]
        assert r["base_sha256"] == sha(",".join(base))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]


def test_random_strings_are_found_and_text_is_not(spark):
    rng = random.Random(7)
    prose = [r["text"] for r in queries.ready(spark).read.parquet(f"{SF}/documents.parquet").filter("text is not null").collect()]
    names = [
        "internationalizationOfThings", "getElementsByClassNameAndTag", "this_is_a_long_variable_name_2", "article/2023/10/11/some-title-here", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
        "00000000000000000000000000000000000", "12345678901234567890123", "abcdefghijklmnopqrstuvwxyz0123456789", "erberbeeinheitkeiterundlich", "https-www-example-com-some-page",
    ]
    alphabets = [secret_scan.ENCODINGS[e] for e in ("base62", "base64", "base64url", "HEX", "base36")]
    keys = [key_of(rng, alphabets[i % 5], n) for n in (24, 32, 40, 64, 300) for i in range(20)]
    rows = [(i, f"é {k} x") for i, k in enumerate(keys)] + [(1_000 + i, f"{n}.") for i, n in enumerate(names)] + [(2_000 + i, p) for i, p in enumerate(prose)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secret_scan.scan(docs).collect()}
    caught = sum((2, 3, 2 + len(k)) in found[i] for i, k in enumerate(keys))
    assert caught >= 0.97 * len(keys)
    assert not [s for i in range(len(names)) for s in found[1_000 + i] if s[1] == 3]
    added = [s for i, spans in found.items() if i >= 2_000 for s in spans if s[1] == 3]
    assert not added


def test_scan_does_not_depend_on_partitions(spark, documents):  # noqa: F811
    docs = documents.select("doc_id", "text")
    one, many = (secret_scan.scan(docs.repartition(n)).collect() for n in (1, 7))
    assert sorted(map(repr, one)) == sorted(map(repr, many))


def test_scan_of_awkward_rows(awkward, empty):  # noqa: F811
    found = secret_scan.scan(awkward).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in AWKWARD)
    assert secret_scan.scan(empty).count() == 0


def test_odd_changes():
    for text in ["aB", "Abc", "xAbcDefG", "A1b2", "THis", "aBCd", "a-b", "AbcD", "AB", "xAb"]:
        want = 0
        for i in range(1, len(text)):
            kinds = [secret_scan._KIND[ord(c)] for c in text]

            def word(j):
                return j >= 0 and list(kinds[j : j + 3]) == [2, 1, 1]

            want += kinds[i] != kinds[i - 1] and not word(i - 1) and not (word(i) and kinds[i - 1] == 1)
        kind = secret_scan._KIND[np.frombuffer(text.encode(), np.uint8)]
        opens = np.zeros(len(kind), bool)
        opens[0] = True
        assert secret_scan.odd_changes(kind, opens).sum() == want, text


def plain_battery(text):
    """Numbers of the three tests for one string, symbol by symbol."""
    name = next(e for e, a in secret_scan.ENCODINGS.items() if set(text) <= set(a))
    alphabet = secret_scan.ENCODINGS[name]
    x, n, k = [alphabet.index(c) for c in text], len(text), len(alphabet)
    same = sum(v * v for v in Counter(x).values())
    upper = [2 * v >= k for v in x]
    runs = 1 + sum(p != q for p, q in zip(upper, upper[1:]))
    mean = sum(x) / n
    down = sum((v - mean) ** 2 for v in x)
    r = sum((p - mean) * (q - mean) for p, q in zip(x, x[1:])) / down if down else float("nan")
    one = [np.array([float(v)]) for v in (same, n, k, sum(upper), runs, r)]
    return name, secret_scan._fisher(
        secret_scan.uniformity(one[0], one[1], one[2]), secret_scan.runs_test(one[3], one[4], one[1]), secret_scan.serial_test(one[5], one[1])
    )[0]


def test_battery_against_plain_version():
    rng = random.Random(11)
    text = secret_scan.Background(np.bincount(np.frombuffer(b"the quick brown fox jumps over 13 lazy dogs", np.uint8), minlength=256), 1000, 20)
    strings = [key_of(rng, secret_scan.ENCODINGS[e], rng.randrange(20, 90)) for e in secret_scan.ENCODINGS for _ in range(20)]
    strings += ["a" * 30, "ab" * 15, "0123456789" * 3, "abcdefghijklmnopqrstuvwxyz0123456789"]
    data, first = words.text_bytes(pa.array(strings))
    encoding, p = secret_scan.battery(data, *secret_scan.candidates(data, first), text)
    assert len(p) == len(strings)
    for s, e, value in zip(strings, encoding, p):
        name, random_p = plain_battery(s)
        assert list(secret_scan.ENCODINGS)[e] == name
        assert (value < 1) <= (random_p >= secret_scan.ALPHA and name != "digits")


def test_randomness_tests_have_their_level():
    """Of random strings, each test rejects about as many as its level says, short ones included."""
    rng = np.random.default_rng(5)
    for n, k in [(24, 16), (24, 64), (40, 36), (400, 64)]:
        x = rng.integers(0, k, (4_000, n))
        same = np.array([(np.bincount(row) ** 2).sum() for row in x]).astype(float)
        upper = x * 2 >= k
        runs = 1 + (upper[:, 1:] != upper[:, :-1]).sum(1)
        off = x - x.mean(1, keepdims=True)
        r = (off[:, 1:] * off[:, :-1]).sum(1) / (off**2).sum(1)
        size, symbols = np.full(len(x), n), np.full(len(x), k)
        for p in (secret_scan.uniformity(same, size, symbols), secret_scan.runs_test(upper.sum(1), runs, size), secret_scan.serial_test(r, size)):
            assert 0.01 < (p < 0.05).mean() < 0.09


def test_step_up_limits():
    """Against the step-up rule on single values."""
    rng = np.random.default_rng(2)
    for seed in range(30):
        p = np.concatenate([rng.random(200), 10.0 ** -rng.uniform(3, 20, rng.integers(0, 40))])
        steps = secret_scan.step_of(p)
        assert (10 ** (-secret_scan.STEP * steps) >= p * 0.999999).all()
        counts = Counter(steps.tolist())
        limit = secret_scan.limits([(5, s, n) for s, n in counts.items()], 0.05).get(5)
        upper = np.sort(10 ** (-secret_scan.STEP * steps))
        passed = np.flatnonzero(upper <= 0.05 * np.arange(1, len(p) + 1) / len(p))
        want = passed[-1] + 1 if len(passed) else 0
        assert (0 if limit is None else (steps >= limit).sum()) == want


def test_long_pages_are_aligned_as_short_ones_are(monkeypatch):
    """The best match at every length: first fit would take the heading's far mate and miss what lies before it."""
    parts = [f"<p>t{i}</p><b>u{i}</b>" for i in range(300)]
    reference = "<body>" + "".join(parts[:20]) + "<h3>other</h3>" + "".join(parts[20:]) + "</body>"
    page = "<body><h3>own</h3>" + "".join(parts) + "</body>"
    assert wrapper.extract(page, [(reference, wrapper.parse(reference))]) == "own"

    def tree(depth):
        inside = [rng.choice(["x", "y", " "]) if depth > 2 or rng.random() < 0.3 else tree(depth + 1) for _ in range(rng.randrange(9))]
        name = rng.choice(["p", "div", "b", "li"])
        return f"<{name}>{''.join(inside)}</{name}>"

    def aligned(cells):
        monkeypatch.setattr(wrapper, "_LIST_CELLS", cells)
        return [[order(wrapper.Alignment(), *pair) for order in (matched, size)] for pair in pairs]

    def matched(alignment, a, b):
        return [(id(x[0]), id(y[0])) for x, y in alignment._pairs(wrapper._runs(a), wrapper._runs(b))]

    def size(alignment, a, b):
        return alignment.size(a, b)

    rng = random.Random(3)
    pairs = [[wrapper.parse("".join(tree(0) for _ in range(12))) for _ in range(2)] for _ in range(40)]
    assert aligned(0) == aligned(1 << 40)
