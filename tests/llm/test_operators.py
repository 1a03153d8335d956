"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib
from array import array

import numpy as np
import pytest

from pyspark.sql import functions as F
from recspark.llm import components, dartminhash, extract, langid, packing, quality, queries, rules, toxicity, urlfilter, warc, winnow

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, row int, score double"


def documents(spark, texts, lang="en", source="s"):
    rows = [(i, t, lang, source, len(t or ""), "x", 1, 0.5) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.2 else f"w{rng.randrange(400)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    base = sentence(rng, 120)
    near = base.split()
    near[60] = "changed"
    item = sentence(rng, 25)
    return [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, "one"), (8, "one two three"),
        (None, "a row without an id, with words"), (9, sentence(rng, 30_000)), (10, "start " + item + " end"), (11, item[:40]),
        (12, "one two three"), (13, "a a a a a a a a"), (14, "A line\nA line\nother\n\n"), (15, "Ünïcödé été " * 30),
    ]


# --- quality rules ---------------------------------------------------------------------------------------------


def brute_counts(t):
    ws = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    seen = collections.Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {i + k for i in range(len(ws) - 2) if seen[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in t or "")
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rule_counts(spark, odd_texts):
    out = rules.judge(documents(spark, odd_texts)).collect()
    got = sorted((r.text or "", (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in out)
    assert got == sorted((t or "", brute_counts(t)) for _, t in odd_texts)
    assert all(not r.kept for r in out if r.base_failed)


def test_repeats_beyond_the_packed_positions(spark, monkeypatch):
    monkeypatch.setattr(rules, "_PLACE", 3)
    out = rules.judge(documents(spark, [(1, "a b c d e a b c x a b c"), (2, "a b c d e f g h i j")])).collect()
    assert {r.doc_id: r.n_repeat_words for r in out} == {1: 9, 2: 0}


def test_windows_alike_in_the_packed_bits_only(spark, monkeypatch):
    monkeypatch.setattr(rules, "_PLACE", 58)  # leaves 6 bits of the hash
    odd = [(1, " ".join(f"w{i}" for i in range(300))), (2, " ".join(f"w{i}" for i in range(300)) + " w7 w8 w9 w10")]
    out = rules.judge(documents(spark, odd)).collect()
    assert {r.doc_id: r.n_repeat_words for r in out} == {1: 0, 2: 8}


def test_order_of_rules_changes_no_verdict(spark, odd_texts):
    df = documents(spark, odd_texts)
    a = rules.judge(df, order=False).select("doc_id", "kept").collect()
    b = rules.judge(df, tuple(reversed(rules.RULES)), order=False).select("doc_id", "kept").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    measured = [{"rule": r.name, "seconds": 1.0, "failures": i, "rows": 9} for i, r in enumerate(rules.RULES)]
    assert rules.ordered(rules.RULES, measured)[0].name == rules.RULES[-1].name


# --- decontamination -------------------------------------------------------------------------------------------


def test_contamination_is_exact(spark, odd_texts):
    item = dict(odd_texts)[10].removeprefix("start ").removesuffix(" end")
    items = [(1, item), (2, "One, TWO three"), (3, None), (4, ""), (5, item), (None, "one two"), (12, item.upper())]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        if n and i is not None:
            for k in range(len(w) - n + 1):
                windows[tuple(w[k : k + n])].add(str(i))
    expected = []
    for i, t in odd_texts:
        w = words(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        expected.append((str(i), len(w), len(hit), sorted(found)))
    for sent in (winnow.MAX_SENT, 0):
        out = winnow.contamination(documents(spark, odd_texts), benchmark, max_sent=sent).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in out) == sorted(expected)


# --- packing -----------------------------------------------------------------------------------------------------


def test_packing_round_trip(spark, odd_texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    out = packing.packed(documents(spark, odd_texts), queries.tokenizer_path(), keep_ids=True).collect()
    cut = collections.Counter()
    for _, text in odd_texts:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or min(len(ids), 2048)
        at = 0
        for n in [first] + [2048] * ((len(ids) - first) // 2048):
            cut[(at, n, array("I", ids[at : at + n]).tobytes())] += 1
            at += n
    assert cut == collections.Counter((r.start, r.length, bytes(r.ids)) for r in out)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in out)
    places = collections.defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) == -(-sum(r.length for r in out) // 2048)


def test_encoder_equals_the_tokenizer():
    e = packing.Encoder(queries.tokenizer_path())
    texts = ["a  b", "a\n\nb", " a", "a ", "\na", "a\n b", "a \nb", "a\tb c", "x y z", "a   b", "it's we'll\nI'm", "", "a\n", "é b", "<|endoftext|> a", "a\x00b c", "a\r\nb", "x y  z"]
    assert e.ranked is not None
    for _ in range(2):
        assert e.encode(texts) == e._ids(texts)


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_the_histogram(seed):
    rng = random.Random(seed)
    histogram = collections.Counter(rng.randint(1, 64) for _ in range(rng.choice([1, 30, 3000])))
    made = packing.plan(histogram, 64)
    held = collections.Counter()
    for pieces, n in made:
        assert sum(length * k for length, k in pieces.items()) <= 64
        for length, k in pieces.items():
            held[length] += k * n
    assert held == histogram
    bins = sum(n for _, n in made)
    least = max(-(-sum(k * n for k, n in histogram.items()) // 64), sum(n for k, n in histogram.items() if k > 32))
    assert bins <= 1.02 * least + 1


def test_knapsack_is_best():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths, weights = np.sort(rng.choice(np.arange(1, 9), 4, replace=False)), rng.random(4)
        best = packing.priced(lengths, weights, 15)
        for room in (0, 3, 15):
            every = np.ndindex(*(room // lengths + 1))
            expected = max(float(weights @ c) for c in every if lengths @ c <= room)
            assert abs(best[room] - expected) < 1e-9
        left = np.full(4, 99)
        config, free = packing.configuration(2, lengths, weights, left, best, 15)
        used = sum(lengths[i] * n for i, n in config.items())
        assert used + free == 15 and config[2] >= 1
        assert abs(sum(weights[i] * n for i, n in config.items()) - weights[2] - best[15 - lengths[2]]) < 1e-9


def test_a_configuration_takes_no_more_than_is_left():
    lengths, weights = np.array([3, 5]), np.array([0.9, 0.5])
    config, free = packing.configuration(1, lengths, weights, np.array([2, 4]), packing.priced(lengths, weights, 20), 20)
    assert config[0] == 2 and config[1] == 2 and free == 4


def test_the_program_places_nearly_all_pieces():
    rng = np.random.default_rng(2)
    for sizes, share in ((np.clip(rng.lognormal(4, 1, 20_000).astype(int) + 1, 1, 512), 0.9), (rng.integers(1, 512, 20_000), 0.8)):
        histogram = collections.Counter(sizes.tolist())
        made = packing.planned(histogram, 512)
        fewest = -(-sum(k * n for k, n in histogram.items()) // 512)
        assert made.programmed >= share
        assert sum(n for _, n in made.made) <= 1.03 * fewest


def test_added_tokens_are_encoded_as_the_tokenizer_does(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    texts = ["hello <|endoftext|> you", "<|endoftext|>", "no mark here", "a<|endoftext|>b\nhello you", "hello <|endof text"]
    got = packing.Encoder(path).encode(texts)
    assert got == [array("I", plain.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]


def test_a_filter_of_fingerprints_finds_all_and_only_them():
    rng = np.random.default_rng(3)
    known = np.unique(np.minimum(rng.integers(0, 2**63, 5000), rng.integers(0, 2**63, 5000)).astype(np.uint64))
    others = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    mixed = np.concatenate([others, known[::7], others[:50]])
    assert (winnow.Known(known).which(mixed) == np.flatnonzero(np.isin(mixed, known))).all()
    for few in (known[:0], known[:1]):
        assert (winnow.Known(few).which(mixed) == np.flatnonzero(np.isin(mixed, few))).all()


# --- near-duplicates -----------------------------------------------------------------------------------------------


def brute_classes(texts, weighted, similarity=0.8):
    words = lambda t: re.findall(r"[0-9a-zA-Z\x80-\U0010ffff]+", t or "")
    sets = []
    for _, t in texts:
        w = [x.lower() for x in words(t)]
        found = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) > 4 else [tuple(w)] if w else []
        sets.append(collections.Counter(found if weighted else set(found)))
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both, all_of = sum((sets[i] & sets[j]).values()), sum((sets[i] | sets[j]).values())
            if (not sets[i] and not sets[j]) or (all_of and both >= similarity * all_of):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(len(texts)):
        groups[root(i)].append(texts[i][0])
    return sorted(sorted(map(str, g)) for g in groups.values())


@pytest.mark.parametrize("weighted", [False, True])
def test_near_duplicates_equal_brute_force(spark, odd_texts, weighted):
    rng = random.Random(5)
    texts = list(odd_texts)
    base_words = sentence(rng, 150).split()
    chain = sentence(rng, 200).split()
    for k in range(12):  # neighbours are near-duplicates, the ends are not
        texts.append((100 + k, " ".join(chain)))
        chain[16 * k + 3] = f"new{k}"
    texts += [(200, sentence(rng, 40) + " so on" * 300), (201, sentence(rng, 40) + " so on" * 310)]  # alike by weight alone
    for k in range(6):  # copies of one text with less in common with each other than with it
        copy = base_words[:]
        for j in range(3):
            copy[10 + 30 * j + 4 * k] = f"edit{k}{j}"
        texts.append((300 + k, " ".join(copy)))
    texts.append((310, " ".join(base_words)))
    out = dartminhash.classes(documents(spark, texts), extra=["lang"], weighted=weighted).collect()
    assert len(out) == len(texts)
    groups = collections.defaultdict(list)
    for r in out:
        groups[r.class_id if r.class_id is not None else f"none{r.doc_id}"].append(str(r.doc_id))
    assert sorted(sorted(g) for g in groups.values()) == brute_classes(texts, weighted)
    assert sum(r.kept for r in out) == len(groups)
    assert all(r.class_id == min(int(x) for x in groups[r.class_id] if x != "None") for r in out if r.class_id is not None)


def test_signatures_agree_like_weighted_similarity():
    a = np.arange(1, 301, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    wa = np.ones(300, np.int64)
    wb = wa.copy()
    wa[:40], wb[200:240] = 3, 2
    row = np.repeat([0, 1], 300)
    s = dartminhash.signatures(row, np.concatenate([a, a]), np.concatenate([wa, wb]), 3, 4000)
    expected = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((s[0] == s[1]).mean() - expected) < 0.03
    assert not s[2].any() and (s[:2] != 0).all()


def test_texts_somewhat_like_a_large_class_do_not_meet_all_of_it(spark):
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(-(2**31), 2**31, n)
    base, often, rows = draw(100), draw(30), []
    change = lambda n: np.concatenate([rng.permutation(base)[n:], draw(n)])
    rows += [(i, 0, change(2)) for i in range(120)]  # one class
    # 0.7 alike to all of it; what differs is more frequent than what is shared
    rows += [(200 + i, 200 + i, np.concatenate([rng.permutation(base)[18:], rng.permutation(often)[:18]])) for i in range(40)]
    rows += [(400 + i, 400, np.concatenate([often, draw(40)])) for i in range(200)]
    rows += [(300 + i, 300 + i, change(8 + i % 2)) for i in range(6)]  # 0.8 alike to much of it
    nodes = spark.createDataFrame([(n, r, e.tolist()) for n, r, e in rows], "node bigint, root bigint, elements array<int>")
    met = [tuple(sorted((r.node, r.other))) for r in dartminhash._prefix_pairs(nodes, 0.8).collect()]
    sets, roots = {n: set(e.tolist()) for n, _, e in rows}, {n: r for n, r, _ in rows}
    similar = {(a, b) for a in sets for b in sets if a < b and roots[a] != roots[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9}
    assert len(similar) > 100 and similar <= set(met)
    assert len({p for p in met if p[0] < 200 <= p[1] < 300}) < 120 * 40 // 4


def test_large_tables_are_removed_after_use(spark, monkeypatch):
    gone = []
    monkeypatch.setattr(dartminhash, "discard", lambda session, path: gone.append(path))
    rng = random.Random(2)
    dartminhash.classes(documents(spark, [(1, sentence(rng, 50)), (2, sentence(rng, 50))])).collect()
    assert {p.rsplit("/", 1)[1].split("-")[0] for p in gone} == {"signatures", "elements"}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    out = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in out} == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)}


# --- language ------------------------------------------------------------------------------------------------------


def test_languages_and_rejections(spark):
    rng = random.Random(1)
    words = {"en": "the and ship tree with house".split(), "de": "der und schiff baum mit haus".split()}
    text = lambda l, n: " ".join(rng.choice(words[l]) for _ in range(n))
    rows = [(i, text(("en", "de")[i % 2], 30), ("en", "de-AT")[i % 2], ("a.example.com", "b.example.de")[i % 2]) for i in range(200)]
    rows += [(1000, text("de", 60), "en", "b.example.de"), (1001, None, "en", "a.example.com"), (1002, "12 34!", "de", None)]
    rows += [(1003, text("en", 40), None, None), (None, text("en", 40), "en", "x"), (1004, text("de", 5000), "de", "new")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(out) == len(rows)
    assert all(out[i].kept and out[i].language == ("en", "de")[i % 2] for i in range(200))
    assert (out[1000].language, out[1000].kept) == ("de", False)
    assert not out[1001].kept and out[1001].language is None and not out[1002].kept
    assert out[1003].kept and out[1003].language == "en" and out[None].kept and out[1004].kept


def test_rare_languages_are_found(spark):
    rng = random.Random(2)
    words = {"en": "the and ship tree with house", "de": "der und schiff baum mit haus", "is": "það og skip tré með hús", "fi": "joka ja laiva puu talo"}
    text = lambda l, n: " ".join(rng.choice(words[l].split()) for _ in range(n))
    rows = [(i, text(("en", "de")[i % 2], 30), ("en", "de")[i % 2], "s") for i in range(1000)]
    rows += [(2000 + i, text("is", 30), "is", "s") for i in range(5)] + [(3000, text("fi", 40), "fi", "s")]  # 0.5 %, 0.1 %
    rows += [(4000, text("en", 60), "is", "s"), (4001, text("is", 60), "en", "s"), (4002, text("is", 60), None, "s"), (4003, "qx 7 zv 3 kk 9 " * 30, "en", "s")]
    rows += [(4004, "ab", "sv", "s"), (4005, "12", "sv", "s")]  # too short for a model of its language
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(out) == len(rows) and all(out[i].kept for i in range(1000))
    assert all((out[i].language, out[i].kept) == ("is", True) for i in range(2000, 2005))
    assert (out[3000].language, out[3000].kept) == ("fi", True)
    assert [(out[i].language, out[i].kept) for i in (4000, 4001, 4002, 4003)] == [("en", False), ("is", False), ("is", True), ("en", True)]
    assert (out[4004].language, out[4004].kept) == (None, True) and not out[4005].kept
    few = {r.doc_id: r for r in langid.identify(df, min_share=0.1).collect()}
    assert all((few[i].language, few[i].kept) == (None, True) for i in (2000, 3000))


def test_many_languages(spark, monkeypatch):
    rng = random.Random(4)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for _ in range(30)]
    rows = [(i, " ".join(rng.choice(words[i % 30]) for _ in range(30)), f"l{i % 30}", "s") for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    code = [f"l{i}" for i in range(30)]
    whole = langid.text_model(df, F.col("text"), F.col("lang"), code)
    monkeypatch.setattr(langid, "_DENSE", 4)
    held = langid.text_model(df, F.col("text"), F.col("lang"), code)
    assert held[0] == whole[0] == code and (held[1] == whole[1]).all()
    assert all(r.kept and r.language == f"l{r.doc_id % 30}" for r in langid.identify(df).collect())


def test_host_prior_decides_where_the_text_says_nothing(spark):
    rows = [(i, "der und haus schiff " * 8, "de", "host.de") for i in range(60)] + [(100 + i, "the and ship house " * 8, "en", "host.com") for i in range(60)]
    rows += [(1, "zz", None, "host.de"), (2, "zz", None, "host.com")]
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, source string")
    out = {r.doc_id: r.language for r in langid.identify(df).collect()}
    assert (out[120], out[121]) == ("de", "en")


# --- classifiers -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name,label,least", [("op8_quality_classifier", "quality", 0.97), ("op10_toxicity", "toxic", 0.96)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.1"
    out = queries.queries()[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = out.filter("held_out").select("predicted", label).collect()
    assert sum(r.predicted == r[label] for r in rows) >= least * len(rows)


def test_scores_of_odd_texts(spark, odd_texts):
    df = documents(spark, odd_texts)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (8, 0, 1), (9, 1, 0), (9, 1, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    score = quality.scorer(spark, quality.train(df, labels))
    out = df.withColumn("score", score("text")).collect()
    assert len(out) == len(odd_texts) and all(0 <= r.score <= 1 for r in out)
    none = quality.scorer(spark, quality.train(df, labels.limit(0)))
    assert {r.score for r in df.select(none("text").alias("score")).collect()} == {0.5}
    for few in (labels, labels.limit(0)):
        toxic = toxicity.scorer(spark, toxicity.train(df, few))
        assert all(0 <= r.score <= 1 for r in df.select(toxic("text")["score"].alias("score")).collect())


def brute_segments(scores):
    """Ruzzo and Tompa's definition: the best interval first, then the same on what lies left and right of it."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    best = max(((total[j] - total[i], -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 1e-9:
        return []
    i, j = best[3:]
    right = [(a + j, b + j) for a, b in brute_segments(scores[j:])]
    return brute_segments(scores[:i]) + [(i, j)] + right


@pytest.mark.parametrize("seed", range(30))
def test_maximal_segments(seed):
    rng = np.random.default_rng(seed)
    scores = rng.normal(-0.2, 1, rng.integers(0, 25))
    assert [(a, b) for a, b, _ in toxicity.maximal_segments(scores)] == brute_segments(scores)


def test_extreme_values_are_recovered():
    rng = np.random.default_rng(2)
    words = rng.integers(50, 5000, 20_000)
    best = (np.log(words) - 3.0 + rng.gumbel(size=len(words))) / 1.7
    scale, log_k = toxicity.fit_extremes(best, words)
    assert abs(scale - 1.7) < 0.1 and abs(log_k + 3.0) < 0.3


def test_evidence_of_many_mild_segments():
    mild, words = [[3.0] * n for n in (0, 1, 8, 9, 40, 400)], np.full(6, 10)
    found = toxicity.evidence(mild, words, 1.5, 1.0)
    assert found[0] == 0 and (np.diff(found) > 0).all()
    alone = [toxicity.evidence([x], words[:1], 1.5, 1.0)[0] for x in mild]
    assert found.tolist() == alone  # not even in the last digit does a row depend on the others
    assert toxicity.evidence([[3.0] * 40 + [0.1] * 500], words[:1], 1.5, 1.0)[0] >= found[4]


# --- web pages -------------------------------------------------------------------------------------------------------

PAGE = """<html><body><div id="wrapper"><div class="top-bar"><a href=/>Home</a> <a href=/a>News</a></div>
<div id="cookie-consent">We use cookies to improve your experience, please accept them all.</div>
<div class="content-area"><h1>Real Title</h1><p>First paragraph of the story, with enough words to be real text.
<p>Second one has a <a href=x>link</a> inside &amp; goes&nbsp;on.</p><script>var a = "</p>";</script></div>
<div id="comments"><h3>2 comments</h3><div class="comment"><p>I liked this article a lot, thank you for writing it.</p></div></div>
<form action=/s><label>Search the site</label><input><button>Go</button></form><footer>Copyright 2020 Example</footer></div>"""
MAIN = "Real Title First paragraph of the story, with enough words to be real text. Second one has a link inside & goes on."


def test_main_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    trees = extract.train(pages)
    assert len(trees) == extract.TREES
    asked = [(1, PAGE), (2, None), (3, ""), (4, "just words"), (5, "<p>" * 3000 + "deep"), (1, PAGE)]
    df = spark.createDataFrame(asked, "page_id bigint, html string")
    out = df.select("page_id", extract.extractor(spark, trees)("html").alias("text")).collect()
    assert [r.text for r in out][:4] == [MAIN, "", "", "just words"] and out[5].text == MAIN
    rows = pages.select("html", extract.extractor(spark, trees)("html").alias("text")).collect()
    plain = lambda h: re.sub(r"<(/?p|/?h1|br)>", " ", re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", h, re.S)[1]))
    import html

    assert sum(" ".join(html.unescape(plain(r.html)).split()) == r.text for r in rows) >= 0.99 * len(rows)


def test_decoding_never_contradicts():
    nodes = extract.parse(PAGE)
    rng = np.random.default_rng(0)
    for _ in range(20):
        kept = extract.decode(nodes, rng.normal(size=len(nodes)))
        assert all(kept[n.parent.order] for n in nodes[1:] if kept[n.order])


def test_archive_round_trip(spark):
    rows = [
        (1, "http://a.example.com/x", "same"), (2, "https://b.example.org/", "same"), (2, "https://b.example.org/", "same"), (3, None, "same"),
        (4, "no scheme", None), (5, "http://a.example.com/x", ""), (None, "http://c.example.net/?q=1#f", "só"), (6, "http://c.example.net/a b\n", "x" * 200_000),
        (7, "http://m.example.com/", "same"),
    ]
    rows += [(100 + i, f"http://h{i % 7}.example.com/{i}", f"page {i // 2}") for i in range(300)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, offset int")
    archive = warc.write_archive(pages, block=8, max_file_bytes=2000)
    out = warc.look_up(spark, archive, pages, with_payload=True).collect()
    newest = {}
    for i, _, h in rows:
        if i is not None:
            newest[h or ""] = max(newest.get(h or "", i), i)
    expected = []
    for i, _, h in rows:
        payload = (h or "").encode()
        first = newest.get(h or "")
        revisit = first is not None and (i is None or i < first)
        expected.append((str(i), len(payload), warc.base32_sha1(payload), "revisit" if revisit else "response", str(first if revisit else None)))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in out) == sorted(expected)
    assert all(hashlib.sha1(r.payload).digest() for r in out if r.record_type == "response")
    missing = spark.createDataFrame([(9999, "http://zz.example.com/"), (-5, "aaa")], "page_id bigint, url string")
    assert warc.look_up(spark, archive, missing).count() == 0


def test_url_verdicts(spark):
    cases = {
        "http://www.Example.NET/en/a": ("www.example.net", "/en/a", "example.net/en/", "allow"),
        "http://example.net": ("example.net", "", None, "allow"),
        "http://example.net?x=/": ("example.net", "", None, "allow"),
        "http://a.example.com/de/": ("a.example.com", "/de/", "example.com/de/", "block"),
        "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "https://x.org/fr/y?z#q": ("x.org", "/fr/y", "org/fr/", "allow"),
        "http://www.listed.com/p/?utm_source=a&b=1": ("www.listed.com", "/p/", None, "block"),
        "http://listed.com/other": ("listed.com", "/other", None, "allow"),
        "nothing": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(u, i, "x") for i, u in enumerate(cases)] + [("nothing", 77, "y")], "url string, page_id int, verdict string")
    listed = spark.createDataFrame([("listed.com/p?b=1",), ("listed.com/p?b=1",), (None,)], "canonical string")
    out = urlfilter.judge(df, listed).collect()
    assert len(out) == len(cases) + 1
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.url], r


def test_listed_names(spark):
    hosts = [f"www.{n}-x.example.{t}" for n in ("spam", "ads", "casino", "cheap", "free", "adult") for t in ("com", "org")]
    pages = spark.createDataFrame([(f"http://{h}/p/?ref=1",) for h in [*hosts, "news.example.com", "adult.example.com"]], "url string")
    out = urlfilter.judge(pages, urlfilter.listed_urls(pages)).collect()
    assert {r.host for r in out if r.verdict == "block"} == set(hosts)
    some = urlfilter.listed_urls(pages, names=("news", "cheap")).collect()
    assert {r.canonical for r in some} == {"cheap-x.example.com/p", "cheap-x.example.org/p"}


def test_bloom_filter_misses_nothing(spark, monkeypatch):
    listed = spark.range(3000).select(F.concat(F.lit("h"), "id").alias("k"))
    asked = spark.range(6000).select(F.concat(F.lit("h"), "id").alias("k"), "id")
    for most in (urlfilter._MAX_BROADCAST_BLOCKS, 0):
        monkeypatch.setattr(urlfilter, "_MAX_BROADCAST_BLOCKS", most)
        out = urlfilter.listed_verdict(asked, "k", listed)
        seen = out.agg(F.count_if(F.col("listed")).alias("listed"), F.count_if(F.col("possible")).alias("possible"), F.count_if(F.expr("listed and not possible")).alias("lost")).first()
        assert seen.listed == 3000 and seen.lost == 0 and seen.possible < 3000 + 3000 * 0.1


# --- empty tables ------------------------------------------------------------------------------------------------------


def test_empty_tables(spark, tmp_path):
    import corpus_pipeline

    tables = {
        "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
        "pages": "page_id bigint, url string, html string",
        "benchmark": "item_id bigint, text string",
        "labels": "doc_id bigint, quality int, toxic int",
        "embeddings": "vec_id bigint, embedding array<float>, label int",
    }
    for name, schema in tables.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in queries.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
