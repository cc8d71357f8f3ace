"""The registered queries on small tables of their own, against results worked out by other means."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import languages, mixing, queries, simhash, templates, warc, windows


def saved_table(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


PAGES = "page_id long, url string, html string, payload string"


def expected_pages(rows):
    first = {}
    for page, _, html, _ in rows:
        payload = (html or "").encode()
        if len(payload) >= 100:
            first[payload] = min(first.get(payload, page), page)
    for page, url, html, _ in rows:
        payload = (html or "").encode()
        revisit = len(payload) >= 100 and first[payload] != page
        yield page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first[payload] if revisit else None


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_warc_query(spark, tmp_path, monkeypatch, broadcast_rows):
    rng = random.Random(1)
    long = ["é" * 50, "x" * 100, "y" * 99, "z" * 5000, "<p>\r\n\r\n" * 30, "", None]
    rows = [(i, rng.choice(["u", None, "a\r\nb"]), rng.choice(long + [str(i) * 120]), "other") for i in rng.sample(range(10_000), 300)]
    folder = saved_table(spark, tmp_path, "pages", rows, PAGES)
    choose = warc.choose_records
    monkeypatch.setattr(warc, "choose_records", lambda pages, least: choose(pages, least, broadcast_rows))
    got = queries.op5_warc(spark, folder)
    assert [f.dataType.simpleString() for f in got.schema.fields[:5]] == ["bigint", "bigint", "string", "string", "bigint"]
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == sorted(expected_pages(rows), key=repr)


def test_warc_repeated_rows_and_bounds(spark, tmp_path):
    """Rows that repeat an id and its payload: one response; archives bounded by bytes; an empty table."""
    rows = [(1, "u", "a" * 200, None)] * 5 + [(1, "v", "a" * 200, None), (2, "u", "a" * 200, None), (None, "u", "a" * 200, None)]
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame(rows, PAGES), path)
    got = warc.read(spark, path).collect()
    assert len(got) == 8 and sum(r.record_type == "response" for r in got) == 1 and {r.refers_to for r in got} == {None, 1}
    noise = [(i, "u", "".join(random.Random(i).choices("abcdefghij", k=3000)), None) for i in range(60)]
    path = str(tmp_path / "b")
    warc.write(spark.createDataFrame(noise, PAGES).coalesce(1), path, archive_bytes=10_000)
    sizes = [r.length for r in spark.read.format("binaryFile").load(path).select("length").collect()]
    assert len(sizes) > 5 and max(sizes) <= 10_000
    assert warc.read(spark, path).where(F.col("error").isNull()).count() == 60
    path = str(tmp_path / "e")
    warc.write(spark.createDataFrame([], PAGES), path)
    assert warc.read(spark, path).count() == 0


def test_short_items_remove_nothing(spark, tmp_path):
    item = "The quick brown fox jumps over the lazy dog near 12 old barns"
    docs = [
        (1, "Well yes, that is so.", "s", "a"),
        (2, "In passing: the answer is not known to anyone.", "s", "a"),
        (3, f"Before it. {item}. After it, yes.", "s", "a"),
        (4, item.replace("12", "77"), "s", "a"),
        (5, "What is the capital of France? Paris.", "s", "a"),
    ]
    bench = [(10, "Yes"), (11, "the answer is"), (12, item), (13, "What is the capital of France?")]
    saved_table(spark, tmp_path, "documents", docs, "doc_id long, text string, source string, _id string")
    folder = saved_table(spark, tmp_path, "benchmark", bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.contaminated, r.item_words) for r in queries.op9_template_decontamination(spark, folder).collect()}
    assert got == {(1, 10): (False, 1), (2, 11): (False, 3), (3, 10): (False, 1), (3, 12): (True, 13), (4, 12): (True, 13), (5, 13): (True, 6)}
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    kept = templates.without_contaminated(rows, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert kept.columns == rows.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]


CLASHES = ["_id", "_key", "_n", "key", "row", "copy_no", "found_id", "kept_key", "size", "expected", "copies", "fp", "group", "n"]


def test_columns_with_the_names_used_inside(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(i, text if i % 2 else f"{text} more {i}", "a" if i % 3 else None, *["x"] * len(CLASHES)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES))
    once = simhash.one_of_each(docs)
    assert once.columns == docs.columns and once.count() >= 1 and once.where("doc_id % 2 = 1").count() <= 1
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert templates.without_contaminated(docs, bench).columns == docs.columns
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy_no_1"] and mixed.count() > 0
    assert mixing.mix(docs.drop("copy_no")).columns[-1] == "copy_no"


def test_a_language_of_most_texts(spark):
    """The sample of a language is that of its smallest hashes, however it is ranked."""
    rows = [(f"text number {i} here", "en") for i in range(3000)] + [(f"texte {i} ici", "fr") for i in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = languages.learn(docs, profile_size=50, sample_per_language=30)
    kept = [r.text for lang in ("en", "fr") for r in docs.where(F.col("lang") == lang).orderBy(F.xxhash64("text")).limit(30).collect()]
    assert found == languages.learn(docs.where(F.col("text").isin(kept)), profile_size=50, sample_per_language=30)


def test_pipeline_without_labels(spark, tmp_path):
    """Without a label no language is known: documents with a letter stay."""
    import corpus_pipeline

    rows = [(1, "some words", None, "a"), (2, "12 34", None, "a"), (3, None, None, "a"), (4, "", "en", "a"), (5, "été", None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5] and kept.columns == docs.columns


@pytest.mark.parametrize("vocabulary", [30, 10**6])
def test_window_pairs_against_brute_force(vocabulary):
    """Passages found in runs of windows: those with a similar passage in another row, whatever pairs were left out."""
    rng, length = np.random.default_rng(4), 8
    contents, runs, starts = [], [], [0]
    for run in range(25):
        base = [rng.integers(1, vocabulary, 2 * length - 1).astype(np.uint32) for _ in range(2)]
        for _ in range(int(rng.integers(2, 14))):
            row = base[rng.integers(2)].copy()
            for _ in range(rng.poisson(1.0)):
                row[rng.integers(len(row))] = rng.integers(1, vocabulary)
            back, ahead = (length - 1, length - 1) if rng.random() < 0.6 else (length - 1, int(rng.integers(0, length)))
            at = np.arange(-(length - 1), length)
            row[(at < -back) | (at > ahead)] = 0
            contents.append(row)
            runs.append(run)
        starts.append(len(contents))
    n = len(contents)
    columns = {"content": [c.tobytes() for c in contents], "ka": np.arange(n), "kb": np.zeros(n, np.int64), "place": np.full(n, 50 << 20)}
    got = np.zeros((n, length), bool)
    for i, j, first, last, other_first, other_last in windows.run_links(columns, np.array(starts), length, 0.8):
        for row, a, b in [*zip(i, first, last, strict=True), *zip(j, other_first, other_last, strict=True)]:
            got[row, a : b + 1] = True
    sets = [[set(c[s : s + length].tolist()) if (c[s : s + length] != 0).all() else None for s in range(length)] for c in contents]
    want = np.zeros((n, length), bool)
    for one in range(n):
        for other in range(n):
            if one != other and runs[one] == runs[other]:
                for s, x in enumerate(sets[one]):
                    want[one, s] |= x is not None and any(y is not None and len(x & y) >= 0.8 * len(x | y) - 1e-9 for y in sets[other])
    assert want.any() and (got == want).all()


# --- secrets --------------------------------------------------------------------------------------

#: Patterns as the contract of op6 words them, with their least lengths and the group that is measured.
SECRETS = {
    "assign": (r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 8, 2),
    "access": (r"AKIA[A-Z0-9]+", 16, 0),
    "hex": (r"[0-9a-f]+", 32, 0),
}


def base_secrets(text):
    found = [
        (m.start(), k, m.end())
        for k, (pattern, least, group) in enumerate(SECRETS.values())
        for m in re.finditer(pattern, text or "")
        if len(m.group(group)) >= least
    ]
    return sorted(found)


def test_secret_query(spark, tmp_path):
    """Counts and digest of the base spans, each all that its pattern matched, on odd texts, NULLs and repeated rows."""
    rng = random.Random(4)
    parts = ["password", "PassWord", "ſecret", "to\u212aen", "token", "api_key", "APIKEY", "api__key", "=", ":", " ", '"', "'", "\n", "\t"]
    parts += ["abcdefgh", "AKIA", "AKIA" + "B2" * 8, "deadbeef" * 4, "0f" * 20, "é", "😀", "\0", "-", ".", "x"]
    texts = [None, "", " ", 'token = "' + "0a" * 20 + '"', "secret=AKIA" + "A1" * 8, "token=secret=abcdefgh", "password=abc token=abcdefghi"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(800)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4])]
    folder = saved_table(spark, tmp_path, "documents", rows, "doc_id long, text string")
    got = queries.op6_secret_field(spark, folder)
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    assert [got.schema[c].dataType.simpleString() for c in columns] == ["bigint"] * 4 + ["string"]
    want = []
    for doc, text in rows:
        base = base_secrets(text)
        joined = ",".join(f"{list(SECRETS)[k]}:{a}:{b}" for a, k, b in base)
        want.append((doc, *[sum(s[1] == k for s in base) for k in range(3)], hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted(want, key=repr)
    texts = {(r.doc_id, r.spans) for r in got.select("doc_id", "spans").collect()}
    assert (3, "assign:0:49,hex:9:49") in texts
