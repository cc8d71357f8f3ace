"""License join, structure repair and prefix trie against brute force and on edge cases, by operator and by query."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import licenses, prefixes, queries, repair

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TURNS = "conv_id long, turn long, role string, text string"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def saved_table(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


# --- licenses -------------------------------------------------------------------------------------


def every_block(text):
    """(first word, words) of each block, found by other means than the operator."""
    window = max(len(WORD.findall(lowered(t.text))) for t in licenses.TEMPLATES)
    at = 0
    for sentence in re.split(r"(?<=[.!?])[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*\n", lowered(text)):
        words = WORD.findall(sentence)
        if len(words) <= 2 * window:
            yield at, words
        else:
            yield from ((at + s, words[s : s + 2 * window]) for s in range(0, len(words) - window, window))
        at += len(words)


def brute_matches(text, threshold):
    out = set()
    for start, words in every_block(text):
        for k, t in enumerate(licenses.TEMPLATES):
            wanted = set(WORD.findall(lowered(t.text)))
            share = len(wanted & set(words)) / len(wanted)
            if share >= threshold - 1e-9:
                out.add((start, start + len(words), k, round(share, 9), set(t.named_by.lower().split()) <= set(words)))
    return out


def license_texts():
    rng = random.Random(5)
    known = sorted({w for t in licenses.TEMPLATES for w in WORD.findall(t.text)})
    texts = [t.text + "." for t in licenses.TEMPLATES]
    for _ in range(60):  # templates with words lost, in the middle of other words
        kept = [w for w in WORD.findall(rng.choice(licenses.TEMPLATES).text) if rng.random() < 0.85]
        texts.append(" ".join(rng.choices(known, k=rng.randrange(6)) + kept) + ".\nOther words stand here. " + " ".join(kept[::-1]))
    texts += [" ".join(rng.choices(known, k=n)) for n in (10, 60, 61, 200, 3000)]
    texts += ["MIT\nLICENSE. Mit-License mit licenses", "The Apache  License; General Public\tLicense MIT License", "xmit license mit licenseé", "", None]
    return texts


def test_license_matches_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(license_texts())), "doc_id long, text string")
    for threshold in (0.5, 0.8, 1.0):
        read = licenses.read_blocks(docs, threshold=threshold)
        got = defaultdict(list)
        for r in licenses.matches(read, threshold=threshold).collect():
            got[r.doc_id].append((r.start, r.end, r.template, round(r.containment, 9), r.named))
        for i, text in enumerate(license_texts()):
            assert sorted(got[i]) == sorted(brute_matches(text, threshold)), (threshold, i, text)


def test_license_query(spark, tmp_path):
    texts = license_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "MIT License", "y"), (0, texts[0], "x")]
    folder = saved_table(spark, tmp_path, "documents", rows, "doc_id long, text string, `row` string")
    got = queries.op11_license_join(spark, folder).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text in enumerate(texts):
        words = WORD.findall(lowered(text))
        places, labels = [], set()
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
            wanted = phrase.split()
            here = [k for k in range(len(words)) if words[k : k + len(wanted)] == wanted]
            places += here
            labels |= {label} if here else set()
        found = brute_matches(text, 0.8)
        more = {licenses.TEMPLATES[k].label for _, _, k, _, named in found if named}
        r = by_id[i]
        assert (r.n_words, r.n_base) == (len(words), len(places)), text
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted(labels)) and r.labels == ",".join(sorted(labels | more))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels | more)
    assert by_id[None].base_labels == "mit" and by_id[None].score == 1.0
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string, words string")).count() == 0


# --- repair ---------------------------------------------------------------------------------------


def dijkstra(rows):
    """(cost, edits) by settling (cost, edits) in order: an independent way to the least of both."""
    following = {0: 2, 1: 2, 2: 3, 3: 2}
    heap, settled = [(0, "", 0, 0)], set()
    while heap:
        cost, edits, at, state = heapq.heappop(heap)
        if at == len(rows) and state in (0, 3):
            return cost, edits
        if (at, state) in settled:
            continue
        settled.add((at, state))
        heapq.heappush(heap, (cost + 5, edits + "I", at, following[state]))
        if at < len(rows):
            row = rows[at]
            heapq.heappush(heap, (cost + 2, edits + "D", at + 1, state))
            if row.fault in (None, "truncated"):
                more = 5 if row.fault else 0
                heapq.heappush(heap, (cost + more + 1, edits + "R", at + 1, following[state]))
                if row.role[:1] == "s" and state == 0:
                    heapq.heappush(heap, (cost + more, edits + "K", at + 1, 1))
                if row.role[:1] == {2: "u", 3: "a"}[following[state]]:
                    heapq.heappush(heap, (cost + more, edits + "K", at + 1, following[state]))
    raise AssertionError


def test_search_equals_dijkstra():
    rng = random.Random(11)
    for n in [*range(9)] * 60 + [40, 120, 300]:
        roles = rng.choices(["user", "assistant", "system", "tool", ""], [8, 8, 2, 1, 1], k=n)
        texts = rng.choices(["a.", "b!", "c", "", "  \t", "d?", "e."], k=n)
        rows = repair.with_faults([(r, t + str(i) * (t == "c") + "." * (t == "e." and i)) for i, (r, t) in enumerate(zip(roles, texts))])
        cost, edits = repair.search(rows)
        assert (cost, edits) == dijkstra(rows), rows
        roles = "".join(r[:1] for r, _ in repair.apply_edits(rows, edits))
        assert re.fullmatch(r"(s?(ua)+)?", roles)


def test_search_keeps_up_with_long_conversations():
    rng = random.Random(2)
    rows = repair.with_faults([(rng.choice(["user", "assistant"]), rng.choice(["x. ", "y "]) + str(i) + rng.choice([".", ""])) for i in range(20_000)])
    assert repair.search(rows) == dijkstra(rows)


def test_faults():
    rows = repair.with_faults([("user", "a."), ("user", "a."), ("assistant", "a."), ("user", "\x0b \r"), ("user", "a\xa0"), ("user", "a. \n")])
    assert [r.fault for r in rows] == [None, "duplicate", None, "blank", "truncated", None]


def damaged_rows(rows):
    """The damage of the query, row by row."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, each in convs.items():
        yield conv, sorted(each, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))


def test_repair_query(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "user", "assistant", "system", None]), rng.choice(["Hi.", "So?", "and", None, "Yes!"]) ))
    rows += [(None, None, None, None), (None, 3, "user", "x."), (500, None, "user", "x."), (500, None, "user", "x."), (500, 2, "assistant", "y.")]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    folder = saved_table(spark, tmp_path, "conversations", rows, TURNS)
    got = {r.conv_id: r for r in queries.op12_structure_repair(spark, folder).collect()}
    assert len(got) == 153
    for conv, each in damaged_rows(rows):
        turns = {t for t, _, _ in each if t is not None}
        checked = repair.with_faults([(role, text) for _, role, text in each])
        cost, audit = dijkstra(checked)
        initials = [r.role[:1] for r in checked]
        faults = [sum(r.fault == f for r in checked) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        text = "\n".join(f"{r}:{t}" for r, t in repair.apply_edits(checked, audit))
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost) == (gaps, *faults, illegal, cost)
        assert (r.audit, r.repaired_sha256) == (audit, hashlib.sha256(text.encode()).hexdigest())
    r = got[dropped]
    assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    nothing = spark.createDataFrame([], TURNS + ", gone_ string")
    assert repair.repair(nothing).count() == 0


# --- prefix trie ----------------------------------------------------------------------------------


def brute_trie(convs):
    """{node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends)} of {conv_id: tuple of turns}."""
    members = defaultdict(list)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    out = []
    for node, each in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in each if convs[c] == node)))
        out.append(
            (
                min(each),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(each),
                len(children[node]),
                sum(not children[n] for n in below),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def turn_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), *range(200, 204), -5, 1234]:
        for turn in range(rng.randrange(1, 7)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "bb", "é", None, ""])))
    return rows


def test_prefix_trie_query(spark, tmp_path):
    rows = turn_rows(4, 130) + [(7, None, "user", "first"), (None, 0, "user", "lost")] + [(300, i, "user", f"{i}") for i in range(700)]
    folder = saved_table(spark, tmp_path, "conversations", rows, TURNS)
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(each, key=lambda x: (x[0] is not None, x[0] or 0))] for c, each in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        rebuilt[conv] = tuple(own.get(base, [])[:h] + turns[h:])
    got = queries.op13_prefix_trie(spark, folder).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(rebuilt)


def test_prefix_trie_of_copies(spark):
    """Many equal conversations: ids of one node in several blocks and ranges; ties by role and text; empty table; other columns."""
    same = [(c, t, "user", x, "z") for c in range(5000) for t, x in ((0, "one"), (1, "two"))]
    more = [(6000, 0, "user", "one", None), (6000, 0, "assistant", "zero", None), (6001, 5, "assistant", "zero", None), (6001, 5, "user", "one", None)]
    turns = spark.createDataFrame(same + more, TURNS + ", node string")
    got = sorted((tuple(r)[2:] for r in prefixes.trie(prefixes.sequences(turns)).collect()), key=repr)
    convs = {c: (("user", "one"), ("user", "two")) for c in range(5000)}
    convs |= {c: (("assistant", "zero"), ("user", "one")) for c in (6000, 6001)}
    assert got == brute_trie(convs)
    empty = spark.createDataFrame([], TURNS)
    assert prefixes.trie(prefixes.sequences(empty)).count() == 0


@pytest.mark.parametrize("text", ["user", "12:user"])
def test_turn_digest_keeps_roles_apart(spark, text):
    turns = spark.createDataFrame([(1, 0, text, "x"), (2, 0, text + "x", "")], TURNS)
    found = prefixes.sequences(turns).collect()
    assert found[0].turns[0].digest != found[1].turns[0].digest
