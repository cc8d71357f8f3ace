"""Operators of the training-data subpackage against brute force and on edge cases."""

import gzip
import hashlib
import io
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import chat, codes, graph, languages, mixing, rules, secrets, shingles, simhash, suffixes, templates, warc, windows

DOCS = "doc_id long, text string, lang string, source string, extra string"


def words(n, seed, vocabulary=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in every column, empty, repeated and long rows, and a column with a clashing name."""
    long_text = " ".join(words(6000, 1))
    rows = [
        (None, None, None, None, None),
        (1, "", "en", "a", "x"),
        (2, None, "en", None, "x"),
        (3, "123 456", None, "a", None),
        (4, "the cat and the dog", "en", "b", None),
        (4, "the cat and the dog", "en", "b", None),
        (5, long_text, "en", "b", None),
        (6, long_text, "en", "b", None),
        (None, "the cat and the dog", "en", "b", None),
    ]
    return spark.createDataFrame(rows, DOCS).withColumnRenamed("extra", "key")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- rules ----------------------------------------------------------------------------------------


def repeated(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    counts, covered = Counter(found), set()
    for k, x in enumerate(found):
        if counts[x] > 1:
            covered.update(range(k, k + 8))
    return len(w), len(covered)


def test_statistics(spark, odd, empty):
    texts = [
        "a b " * 30,
        "one two\none two\n \n\none two",
        " ".join(words(30, 3) + words(12, 4) + words(3, 5) + words(12, 4)),
        "x y z a b c d e " * 2 + "q",
        "É|é #",
        "",
        None,
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in rules.statistics(docs).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_words, got[i].n_repeat_words) == repeated(t), t
        assert got[i].word_chars == sum(len(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        lines = [x for x in (t or "").split("\n") if x.strip()]
        assert got[i].n_dup_lines == len(lines) - len(set(lines))
    assert got[4].n_symbols == 2
    assert rules.statistics(odd).count() == 9 and rules.statistics(empty).count() == 0


def test_rules_learn_a_threshold(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(600):
        x, y = rng.random(), rng.random()
        rows.append((int(x > 0.8 or y > 0.9), *([0.0] * 1), x, y, *([0.0] * 6)))
    frame = spark.createDataFrame(rows, "bad int, " + ", ".join(f"{f} double" for f in rules.FEATURES))
    found = rules.learn(frame)
    assert {c.feature for r in found for c in r.conditions} == set(rules.FEATURES[1:3])
    wrong = frame.where(rules.verdict(found).isNotNull().cast("int") != F.col("bad")).count()
    assert wrong < 30
    assert rules.learn(frame.limit(0)) == []
    assert rules.learn(frame.withColumn("bad", F.lit(None).cast("int"))) == []


# --- chat -----------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    odd_texts = ["</s>[INST] ok [/INST]", "<\\s> <\\\\/s>", "[NEXT]", "[ROLE:x] y [/ROLE]", "<", "[", "", None, "a\nb\\", "<s>"]
    rows = [(1, i, ["user", "assistant", "tool x]", None][i % 4], t) for i, t in enumerate(odd_texts)]
    rows += [(2, 0, "assistant", "a"), (2, 1, "assistant", None), (2, 2, "assistant", "b"), (None, None, "user", "q")]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same")]
    random.Random(1).shuffle(rows)
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in out.select("*", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("l")).collect()}
    for conv in (1, 2, 3, None):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[conv].t] == [(r[2] or "", r[3] or "") for r in mine]
        assert got[conv].l == "".join(r[3] or "" for r in mine if r[2] == "assistant")
    assert got[2].formatted == "<s>a[NEXT][NEXT]b</s>"
    assert out.limit(0).count() == 0


# --- languages ------------------------------------------------------------------------------------


def test_languages(spark, odd, empty):
    rows = [("xx", "abab abba baab " * 5 + str(i)) for i in range(5)] + [("yy", "cdcd dccd ddcc " * 5 + str(i)) for i in range(5)]
    profiles = languages.learn(spark.createDataFrame(rows, "lang string, text string"))
    texts = spark.createDataFrame([("baba abab",), ("dcdc",), ("12 ²",), (None,), ("",)], "text string")
    got = [r[0] for r in texts.select(languages.identify(F.col("text"), profiles).alias("x")).select("x.lang").collect()]
    assert got == ["xx", "yy", "und", "und", "und"]
    assert languages.learn(empty) == {}
    found = odd.select(languages.identify(F.col("text"), languages.learn(odd)).alias("x")).select("x.*").collect()
    assert all(0 <= r.score <= 1 for r in found) and len(found) == 9


def test_out_of_place_distance():
    known = languages.Profiles({"x": {"a": 0, "c": 1} | {str(k): k for k in range(2, 10)}})
    grams = np.array([languages._number(g) for g in "abc"])
    assert known.distance(grams, "x") == 0 + 10 + 1


# --- secrets --------------------------------------------------------------------------------------


def test_pattern_spans():
    text = 'Token = "' + "ab12" * 10 + '" password:x AKIA' + "A1" * 6 + " paſſword=12345678"
    got = secrets.pattern_spans(text)
    assert [(secrets.KINDS[k], text[a:b]) for a, k, b in got] == [
        ("assign", "ab12" * 10),
        ("hex", "ab12" * 10),
        ("access", "AKIA" + "A1" * 6),
    ]
    assert secrets.without("a 12 b", [(2, 0, 3), (2, 1, 4)], "#") == "a # b"


def test_pruned_viterbi_is_exact():
    rng = np.random.default_rng(1)
    field = secrets.Field(np.zeros((secrets.SLOTS, 3), np.float32), rng.normal(size=(3, 3)))
    decoder = secrets.Decoder(field)
    tokens = ["a" * 2**i for i in range(7)]  # tokens of one shape share their scores
    for _ in range(20):
        decoder._restart()
        numbers = decoder._numbers(tokens)
        decoder.scores[numbers, 0] = rng.normal(size=(7, 3)) * 3 + np.array([2.0, 0, 0])
        own = decoder.scores[numbers, 0]
        best = max(
            np.ndindex(*[3] * 7),
            key=lambda y: sum(own[i, y[i]] for i in range(7)) + sum(field.between[a, b] for a, b in zip(y, y[1:], strict=False)),
        )
        assert [decoder.labels(tokens).get(i, 0) for i in range(7)] == list(best)


def test_secret_scan(spark, odd, empty):
    rows = [(i, f"some words here password={hashlib.md5(str(i).encode()).hexdigest()[:16]} and more") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    field = secrets.learn(docs)
    cleaned = docs.select(secrets.redact(F.col("text"), field)).collect()
    assert all(r[0] == "some words here password=[SECRET] and more" for r in cleaned)
    assert secrets.learn(empty) is None
    assert odd.select(secrets.scan(F.col("text"), None).alias("s")).where("size(s) > 0").count() == 0


def test_field_finds_secrets_without_keyword(spark):
    """Held out: names, beginnings and values that training does not make; text without secrets stays clean."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(900)]

    def prose(n):
        return " ".join(w.title() + "." if rng.random() < 0.1 else w for w in rng.choices(words, k=n))

    train = [(i, "\n".join(prose(30) for _ in range(4))) for i in range(300)]
    train += [(1000 + i, f"{prose(8)} password = {rng.getrandbits(100):x}g {prose(5)}") for i in range(60)]
    field = secrets.learn(spark.createDataFrame(train, "doc_id long, text string").repartition(7))
    decoder = secrets.Decoder(field)
    planted = []
    for i in range(300):
        value = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=rng.randint(20, 44)))
        before = ["", "db_cred=", "hook: ", "deploy_key = ", "rk_test_", "session='"][i % 6]
        head = prose(12) + " " + before
        planted.append((len(head), len(head) + len(value), head + value + " " + prose(9)))
    hit = sum(any(a < e and s < b for a, k, b in secrets.all_spans(t, decoder) if k == 3) for s, e, t in planted)
    assert hit >= 0.9 * len(planted), hit
    clean = [prose(60) + f" {rng.randint(10**9, 10**15)} 2024-03-{i % 28 + 1:02} ann.{i}@mail{i % 9}.example.com 10.0.{i % 250}.7" for i in range(300)]
    assert sum(bool(secrets.all_spans(t, decoder)) for t in clean) <= 3
    assert secrets.all_spans("password=abcd1234efgh", decoder) == secrets.pattern_spans("password=abcd1234efgh")
    again = secrets.learn(spark.createDataFrame(train[::-1], "doc_id long, text string").repartition(3))
    assert (again.weights == field.weights).all()


# --- fingerprints ---------------------------------------------------------------------------------


def test_golay_code():
    assert len(np.unique(codes._errors())) == 2048
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 20, 500)
    for bit in range(20):
        mine = codes.neighbour_indices(x, 20)
        assert (mine == codes.index_table(20)[x ^ (1 << bit)][:, None]).any(axis=1).all()


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    made = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in made]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "É É", "a B c d", "x " * 9000])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) % 2**64 == slow_fingerprint(text)


@pytest.mark.parametrize("tile", [3, 4096])
def test_links_connect_all_within_three_bits(spark, tile):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:40]:
        for _ in range(3):
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            prints.add(p)
    prints = sorted(prints)
    want = {p: p for p in prints}

    def root(p):
        while want[p] != p:
            p = want[p]
        return p

    for a, b in combinations(prints, 2):
        if bin(a ^ b).count("1") <= 3:
            want[max(root(a), root(b))] = min(root(a), root(b))
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    found = graph.components(simhash.links(spark.createDataFrame(signed, "fp long"), tile))
    groups = {}
    for r in found.collect():
        groups.setdefault(r.component, set()).add(r.node % 2**64)
    expected = {}
    for p in prints:
        expected.setdefault(root(p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_simhash_edges(spark, odd, empty):
    got = simhash.classes(odd).collect()
    assert len(got) == 9 and {r.component_id for r in got if r.fp == 0} == {1}
    kept = simhash.one_of_each(odd).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 4, 5] and "key" in kept[0].asDict()
    assert simhash.classes(empty).count() == 0


# --- repeated passages ----------------------------------------------------------------------------


def repeated_spans(texts, least):
    hashed = {i: (t or "").lower().split() for i, t in texts.items()}
    counts = Counter(tuple(w[k : k + least]) for w in hashed.values() for k in range(len(w) - least + 1))
    out = set()
    for i, w in hashed.items():
        spans = []
        for k in range(len(w) - least + 1):
            if counts[tuple(w[k : k + least])] > 1:
                if spans and spans[-1][1] >= k:
                    spans[-1][1] = k + least
                else:
                    spans.append([k, k + least])
        out |= {(i, a, b) for a, b in spans}
    return out


@pytest.mark.parametrize("largest", [3, 50_000])
def test_repeated_passages(spark, largest):
    rng = random.Random(7)
    shared = [words(rng.randint(8, 40), 100 + k, 30) for k in range(6)]
    texts = {}
    for i in range(60):
        parts = []
        for _ in range(3):
            parts += words(rng.randint(0, 30), 1000 * i + rng.randint(0, 99), 30)
            piece = rng.choice(shared)
            parts += piece[rng.randint(0, 5) : len(piece) - rng.randint(0, 5)]
        texts[i] = " ".join(parts)
    texts[60] = texts[61] = " ".join(words(30, 9))
    texts[62], texts[63] = "same " * 80, None
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {tuple(r) for r in suffixes.spans(docs, least=12, anchor=7, largest=largest).collect()}
    assert got == repeated_spans(texts, 12)


def test_repeated_passages_edges(odd, empty):
    got = {tuple(r) for r in suffixes.spans(odd).collect()}
    assert got == {(5, 0, 6000), (6, 0, 6000)}
    assert suffixes.spans(empty).count() == 0


def test_compact_windows_cover_every_passage():
    rng = np.random.default_rng(4)
    for values in (rng.integers(0, 1000, 60).astype(np.uint64), rng.integers(0, 4, 60).astype(np.uint64)):
        l, c, r = windows.compact_windows(values, 9)
        for i in range(60):
            for j in range(i + 8, 60):
                at = i + int(values[i : j + 1].argmin())
                assert ((l <= i) & (c == at) & (r >= j)).sum() == 1


def test_near_duplicate_passages(spark, odd, empty):
    passage = words(70, 11)
    edited = list(passage)
    edited[35] = "changed"
    texts = [
        words(40, 21) + passage + words(40, 22),
        words(10, 23) + edited + words(60, 24),
        words(120, 25),
        words(30, 26) + passage[:20] + words(50, 27),
    ]
    docs = spark.createDataFrame([(10 + i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = windows.passages(docs).collect()
    assert {(r.doc_id, r.class_id) for r in got} == {(10, 10), (11, 10)}
    assert all(r.end - r.start >= 50 and r.start >= 0 for r in got)
    whole = {tuple(r) for r in windows.passages(odd).collect()}
    assert whole == {(5, 5, 0, 6000), (6, 5, 0, 6000)}
    assert windows.passages(empty).count() == 0


def similar_words(one, other):
    """Words of ``one`` in a passage of 50 words that has a similar one in ``other``, every two compared."""
    a, b = ([tuple(t[k : k + 5]) for k in range(len(t) - 4)] for t in (one, other))
    there = [set(b[t : t + 46]) for t in range(len(b) - 45)]
    covered = set()
    for s in range(len(a) - 45):
        x = set(a[s : s + 46])
        if any(len(x & y) >= 0.8 * len(x | y) for y in there):
            covered.update(range(s, s + 50))
    return covered


def test_near_duplicate_passages_are_whole(spark):
    sizes = (51, 60, 70, 100, 150)
    texts = []
    for k, size in enumerate(sizes):
        passage = words(size, 1000 + k, 10**6)
        texts += [words(40, seed, 10**6) + passage + words(45, seed + 1, 10**6) for seed in (2000 + 4 * k, 2002 + 4 * k)]
    # the third text shares the whole passage with the second only
    texts.append(words(50, 3000, 10**6) + texts[9][20:190] + words(50, 3001, 10**6))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    covered = {i: set() for i in range(len(texts))}
    for r in windows.passages(docs).collect():
        covered[r.doc_id].update(range(r.start, r.end))
    for k, size in enumerate(sizes):
        for i, j in ((2 * k, 2 * k + 1), (2 * k + 1, 2 * k)):
            assert set(range(40, 40 + size)) <= covered[i]
            if i < 8:
                assert covered[i] <= similar_words(texts[i], texts[j])
    assert set(range(20, 190)) <= covered[9] and set(range(50, 220)) <= covered[10]


def test_links_of_a_run_are_those_of_brute_force():
    rng = np.random.default_rng(8)
    length, rows = 12, []
    base = rng.integers(1, 30, 2 * length - 1).astype(np.uint32)
    for k in range(40):
        row = base.copy()
        row[rng.integers(0, len(row), k % 7)] = rng.integers(1, 60, k % 7)
        if k % 5 == 0:
            row = np.concatenate([row[1:length], [7], row[length:]]).astype(np.uint32)[: 2 * length - 1]
        row[: rng.integers(0, 6)] = 0
        rows.append(row)
    place = np.array([100 + 5 * (k % 3) for k in range(40)], np.int64) << 20
    ka = np.array([k // 3 for k in range(40)], np.int64)
    columns = {"content": [r.tobytes() for r in rows], "place": place, "ka": ka, "kb": ka}
    for starts in (np.array([0, 40]), np.array([0, 18, 40])):
        got = set()
        for row, other, first, last, *_ in windows.run_links(columns, starts, length, 0.8):
            got |= {(int(i), s) for i, a, b in zip(row, first, last) for s in range(a, b + 1)}
        expected = set()
        for i, j in ((i, j) for i in range(40) for j in range(40)):
            near = ka[i] == ka[j] and abs(int(place[i] >> 20) - int(place[j] >> 20)) < length
            if near or np.searchsorted(starts, i, "right") != np.searchsorted(starts, j, "right"):
                continue
            for s in range(length):
                x = set(rows[i][s : s + length].tolist())
                for t in range(length):
                    y = set(rows[j][t : t + length].tolist())
                    if 0 not in x | y and len(x & y) >= 0.8 * len(x | y):
                        expected.add((i, s))
        assert got == expected and expected


def test_minima_are_leftmost():
    assert shingles.minima(np.array([3, 1, 1, 5, 0], np.uint64), 2).tolist() == [1, 2, 4]


# --- templates ------------------------------------------------------------------------------------


def test_templates(spark, odd, empty):
    item = "In the morning Anna bought 12 apples and 5 pears so she paid 12 dollars more than on the day before"
    other = item.replace("Anna", "Robert").replace("12", "31").replace("5 ", "7 ")
    broken = item.replace("12 apples", "31 apples").replace("5 ", "7 ")
    docs = spark.createDataFrame(
        [(1, "Well. " + other + " Indeed."), (2, broken), (3, "nothing of the kind is here at all today"), (4, item.upper()), (5, None)],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame([(9, item), (None, None), (8, "")], "item_id long, text string")
    for limit in (1_000_000, 0):
        got = {(r.doc_id, r.item_id): r.consistent for r in templates.matches(docs, bench, broadcast_rows=limit).collect()}
        assert got[1, 9] is True and got[2, 9] is False and not [k for k in got if k[0] in (3, 5)]
    assert 1 not in {r.doc_id for r in templates.without_contaminated(docs, bench).collect()}
    assert templates.without_contaminated(odd, bench).count() == 9
    assert templates.matches(empty, bench).count() == 0
    assert templates.matches(odd, bench.limit(0)).count() == 0


def found_in(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.consistent for r in templates.matches(docs, bench).collect()}


def test_templates_dense_in_numbers(spark):
    item = "A rectangle is 12 cm by 5 cm by 3 cm; find 2 sides."
    sums = "12 + 5 = 17 8 + 4 = 12 6 + 6 = 12 9 + 2 = 11"
    texts = [f"They say: {item} Good.", "so " + item.replace("12", "14").replace("5 ", "6 "), "see " + sums, "13 + 5 = 18 7 + 4 = 11 6 + 7 = 13 9 + 3 = 12"]
    assert found_in(spark, texts, [(1, item), (2, sums)]) == {(0, 1): True, (1, 1): True, (2, 2): True}


def test_templates_of_short_items(spark):
    texts = ["We asked: What is the capital of France? Nobody knew it on that long day", "what is the capital city then", "it was 7 miles to go from here to there"]
    items = [(1, "What is the capital of France?"), (None, "7 miles to go"), (3, "8 miles to go")]
    assert found_in(spark, texts, items) == {(0, 1): True, (2, None): True}
    long_item = "the old miller counted all the sacks twice before the winter came"
    assert found_in(spark, ["Then " + long_item], [(None, long_item)]) == {(0, None): True}


def test_template_runs_are_judged_alone(spark):
    item = "the farmer sold 12 eggs to the baker on a market day and then later in the same week again the farmer sold 12 eggs to the baker on a market day"
    parts = item.split()
    parts[14:18] = ["or", "12", "or", "13"]  # the middle is edited with equal length
    edited = " ".join(parts)
    kept = "the farmer sold 12 eggs to the old baker on a market day when it was raining in all the towns of the valley"
    other = kept + " and 12 eggs to the baker"
    broken = kept.replace("12", "13") + " and 14 eggs to the baker"
    got = found_in(spark, [edited, broken], [(1, item), (2, other)])
    assert got[0, 1] is True and got[1, 2] is True


def test_templates_in_other_case_and_space(spark):
    item = "yesterday old Anna walked 5 km with Robert over 7 km of hills and then Maria ran 3 km with Anna"
    texts = [item.lower(), item.upper(), item.replace(" ", "\n"), item.replace(" ", "  ")]
    assert found_in(spark, texts, [(1, item)]) == {(k, 1): True for k in range(4)}


# --- archives -------------------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    big = "".join(chr(33 + x % 90) for x in range(3000))
    pages = [(3, "u3", big), (1, "u1", big), (2, "u2\r\nX: y", big), (4, None, None), (5, "u", ""), (6, "u", "short"), (7, "u", "short")]
    pages += [(8, "a", "é" * 90), (8, "b", "é" * 90), (None, "n", big)]
    path = str(tmp_path / "archives")
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string")
    warc.write(frame, path, records_per_file=3)
    got = warc.read(spark, path).collect()
    assert len(got) == len(pages) and not any(r.error for r in got)
    at = {r.page_id: r for r in got if r.page_id != 8}
    for page_id, _, html in pages:
        if page_id != 8:
            data = (html or "").encode()
            assert (at[page_id].payload_bytes, at[page_id].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    assert [at[i].refers_to for i in (1, 2, 3, None, 6, 7)] == [None, 1, 1, 1, None, None]
    assert sorted(r.record_type for r in got if r.page_id == 8) == ["response", "revisit"]


def test_warc_members(tmp_path):
    record = warc.record_bytes(1, "u", b"abc" * 50, hashlib.sha256(b"abc" * 50).hexdigest(), None, False)
    assert gzip.GzipFile(fileobj=io.BytesIO(warc.member_of(record))).read() == record
    two = warc.member_of(record) * 2
    assert len(list(warc.records(two))) == 2
    with pytest.raises(ValueError):
        list(warc.records(two[:-5]))
    damaged = record.replace(b"abcabc", b"abdabc", 1)
    headers, block = next(warc.records(warc.member_of(damaged)))
    with pytest.raises(ValueError):
        warc.checked(headers, block)
    long = warc.member_of(b"x" * (1 << 24))
    assert long[-1] == 0 and b"".join([gzip.decompress(long)]) == b"x" * (1 << 24)


# --- mixing ---------------------------------------------------------------------------------------


def test_mixing(spark, odd, empty):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a"] * 8 + ["b", "c", None]), " ".join(["w"] * rng.randint(0, 60))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.allocate(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(900))
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(1.5 * sum(r.size for r in got))
    for source in ("a", "b", "c", None):
        mine = [r for r in got if r.source == source]
        assert mine[0].target <= 2 * mine[0].source_size + 1e-6
        assert sum(r.taken for r in mine) == pytest.approx(mine[0].target, rel=0.03)
    assert all(0 <= r.copies <= 2 for r in got)
    again = {r.doc_id: r.copies for r in mixing.allocate(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in got}
    assert mixing.mix(docs).count() == sum(r.copies for r in got if r.size)
    assert mixing.allocate(odd).count() == 9 and mixing.allocate(empty).count() == 0
    assert "key" in mixing.mix(odd).columns


def test_each_pattern_runs_once_a_text(spark):
    """Inside lambdas an expression is computed as often as it is named; the words of a text name each pattern once."""
    df = spark.createDataFrame([("a",)], "text STRING")
    for made, patterns in ((templates.marked_words, 5), (templates.slot_words, 2)):
        plan = df.select(made(F.col("text")))._jdf.queryExecution().analyzed().toString()
        assert plan.split(" AS ")[0].count("regexp_replace(") == patterns
