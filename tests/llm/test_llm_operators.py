"""The training-data operators against brute force, round trips and hard rows, on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from comparison import as_bag
from pyspark.sql import functions as F

from shelfwise.llm import dialogues, topk
from shelfwise.llm.chosen_path import drop_near_copies, join_near
from shelfwise.llm.dialogues import rotate_perspectives
from shelfwise.llm.licences import scan_licences
from shelfwise.llm.mixing import mix_sources, repeat_documents
from shelfwise.llm.phrases import fingerprint_documents
from shelfwise.llm.pieces import MODEL, Pieces, decode_documents, encode_documents
from shelfwise.llm.repeats import cut_repeats, remove_repeats
from shelfwise.llm.sharding import shard_documents
from shelfwise.llm.topk import top_k
from shelfwise.llm.toxicity import fit, sentences, toxicity_scores

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, key long, row long, rank int"
LONG = " ".join(f"word{i % 97}{i % 13}" for i in range(4000))
TEXTS = [
    (1, LONG, "en", "a"),
    (2, LONG, "en", "a"),
    (3, LONG.replace("word11", "other", 1), "en", "b"),
    (4, "", "en", "b"),
    (5, None, None, None),
    (6, "naïve été 日本語 text\nReleased under the MIT License.\nend", "fr", "c"),
    (7, "one two", "en", None),
    (7, "one two", "en", None),
    (None, "x" * 120 + " " + LONG[:300], "en", "b"),
    (8, "ééééééééééééééééééééééééééééééééééééééééé" + LONG[:80], "fr", "c"),
    (9, "  spaced \t out \n\n", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, g, s, None if t is None else len(t), 5, 6, 7, 8) for i, t, g, s in TEXTS]
    return spark.createDataFrame(rows, DOCS)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    for operator in (mix_sources, shard_documents, scan_licences, join_near, drop_near_copies, remove_repeats,
                     fingerprint_documents, encode_documents, repeat_documents, cut_repeats):
        assert operator(none).count() == 0, operator.__name__
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(vectors).count() == 0
    assert rotate_perspectives(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0
    assert toxicity_scores(docs, spark.createDataFrame([], "doc_id long, toxic int")).count() == len(TEXTS)


def test_pieces_equal_the_library(spark, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = Pieces(open(MODEL, "rb").read())
    texts = [t or "" for _, t, _, _ in TEXTS] + ["a  b", " x ", "\n", "ab" * 700, "▁a▁ b", "日本" * 90, "<s> hi</s>", "é́\x00"]
    for text in texts:
        assert pieces.encode(text).tolist() == library.encode(text)
        if "▁" not in text:
            assert pieces.decode(pieces.encode(text)) == text
    got = Counter((r["doc_id"], tuple(r["ids"]), r["decoded_equal"]) for r in encode_documents(docs).collect())
    assert got == Counter((i, tuple(library.encode(t or "")), True) for i, t, _, _ in TEXTS)


def test_decode_documents(spark, docs):
    import sentencepiece

    back = Counter(tuple(r) for r in decode_documents(encode_documents(docs)).collect())
    assert back == Counter((i, t or "") for i, t, _, _ in TEXTS)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = np.random.default_rng(6)
    letters = [i for i in range(library.get_piece_size()) if not library.is_byte(i)]
    rows = [(n, rng.choice(letters, n).tolist()) for n in range(40)] + [(None, [letters[5]]), (7, None), (7, None)]
    table = spark.createDataFrame(rows, "doc_id long, ids array<int>").withColumn("text", F.lit("clash"))
    got = Counter(tuple(r) for r in decode_documents(table).collect())
    assert got == Counter((i, library.decode(ids) if ids else "") for i, ids in rows)
    assert decode_documents(table.limit(0)).count() == 0
    for wrong in ([-1], [library.get_piece_size()], [5, None]):
        with pytest.raises(Exception, match="document 3: an id that is not"):
            decode_documents(spark.createDataFrame([(3, wrong)], "doc_id long, ids array<long>")).collect()


def test_pieces_by_score_are_the_best_path():
    pieces = Pieces(open(MODEL, "rb").read(), "score")
    text = "▁wherever" * 30

    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - pieces.max_piece), end):
            score = pieces.score_of.get(text[begin:end], pieces.worst if end == begin + 1 else -math.inf)
            best[end] = max(best[end], best[begin] + score)
    found = list(pieces.segments(text))
    assert "".join(found) == text
    assert sum(pieces.score_of.get(p, pieces.worst) for p in found) == pytest.approx(best[-1])


def test_mix(spark, docs):
    rows = [r.asDict() for r in mix_sources(docs).collect()]
    again = [r.asDict() for r in mix_sources(docs.repartition(5)).collect()]
    assert as_bag(list(rows[0]), [tuple(r.values()) for r in rows]) == as_bag(list(rows[0]), [tuple(r.values()) for r in again])
    words = Counter()
    for _, text, _, source in TEXTS:
        words[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted((s for s in words if s is not None)) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        rest = sum(words.values()) - sum(3 * words[s] for s in full)
        target = {s: 3 * words[s] if s in full else rest * weight[s] / sum(weight[x] for x in names if x not in full) for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * words[s]}
        if not over:
            break
        full |= over
    for row in rows:
        assert row["source_size"] == words[row["source"]]
        assert row["target"] == pytest.approx(target[row["source"]])
        assert 0 <= row["taken"] <= 3 * row["size"]


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (i * 37 % 211), f"s{i % 7 if i % 3 else 0}") for i in range(3000)]
    mixed = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.01)


def test_shards(spark, docs):
    rows = [(i, "same" if i % 3 == 0 else f"text {i} " * (i % 50), "en") for i in range(4000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = shard_documents(table).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(range(4000))
    sizes, slots = Counter(), {}
    for r in got:
        text = rows[r["doc_id"]][1].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "bytes", None)
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.05 * sum(sizes.values()) / 16
    assert shard_documents(docs).count() == len(TEXTS)


def test_licences(spark):
    texts = ["RELEASED under the MIT licence", "a\nCopyright 2020 x\nLicensed under CC BY-NC 4.0.\nb", None, "", "MIT", "v"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(1, texts[1], "y")]
    got = scan_licences(spark.createDataFrame(rows, "doc_id long, text string, licence string")).collect()
    assert sorted((r["doc_id"], r["whole_licence"] or "", r["line_licences"], r["n_lines"]) for r in got) == [
        (0, "MIT", "MIT", 1), (1, "", "CC-BY-NC-4.0", 1), (1, "", "CC-BY-NC-4.0", 1), (2, "", "", 0), (3, "", "", 0), (4, "", "", 0), (5, "", "", 0)
    ]


def test_whole_licence_texts(spark):
    import textwrap

    from shelfwise.llm.licences import TEXT_FILES, TEXTS

    rows, want = [], {}
    for file, licence, titles in TEXT_FILES:
        text = (TEXTS / f"{file}.txt").read_text(encoding="utf-8")
        forms = [text, text.replace("https:", "http:"), *(f"{t}\n\nCopyright (c) 2020, A. Body\n\n{text}" for t in titles)]
        if "END OF TERMS" in text:
            forms.append(text[: text.index("END OF TERMS")])
        # The same words in lines of another length; notices of copyright keep their lines.
        parts = re.split(r"(?m)(^[ \t]*copyright (?:\(c\)|\[y).*\n)", text, flags=re.I)
        forms += ["\n".join(p if n % 2 else textwrap.fill(p, width) for n, p in enumerate(parts)) for width in (50, 72, 100) if "****" not in text]
        for form in forms:
            want[len(rows)] = licence
            rows.append((len(rows), form))
        want[len(rows)] = None
        rows.append((len(rows), text + "\nand more"))
    got = {r["doc_id"]: r["whole_licence"] for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
    assert {"BSD-2-Clause", "BSD-3-Clause", "Unlicense", "Zlib", "BSL-1.0", "Apache-2.0", "MPL-2.0"} <= set(got.values())


def test_dialogues(spark):
    rows = [(1, 0, "system", "s", 9), (1, 1, "ann", "hi", 9), (1, 2, "bob", "yo", 9), (1, 2, "bob", "yo", 9), (1, 3, None, None, 9),
            (None, 5, "ann", "x", 9), (2, 0, "system", "only", 9), (1, 1000, "ann", "late", 9)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, part int")
    got = rotate_perspectives(table)
    db = duckdb.connect()
    db.execute("create table conversations(conv_id bigint, turn integer, role varchar, text varchar, part integer)")
    db.executemany("insert into conversations values (?, ?, ?, ?, ?)", rows)
    want = db.execute(dialogues.COMPARISON)
    assert as_bag(got.columns, got.collect()) == as_bag([d[0] for d in want.description], want.fetchall())
    ann = next(r for r in got.collect() if (r["conv_id"], r["speaker"], r["part"]) == (1, "ann", 0))
    assert [ann["rendered"][int(a) : int(b)] for a, b in (s.split("-") for s in ann["mask"].split(";"))] == ["hi"]


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 1) for i in range(400)]
    rows += [(400, rows[50][1], 1), (401, None, 1), (402, [1.0, None], 1), (403, [float("nan")] * 8, 1), (450, [1.0], 1), (451, [], 1), (50, rows[50][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    good = [(i, np.floor(256 * np.float32(v).astype(float))) for i, v, _ in rows if v is not None and None not in v and np.isfinite(v).all()]
    want = Counter()
    for a, (q, v) in enumerate(good):
        if q % 50 == 0:
            scored = [(-int(sum(x * y for x, y in zip(v, w))), i) for b, (i, w) in enumerate(good) if b != a]
            want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:5]))
    for blocks in ({}, {"query_block": 4, "item_block": 64}):
        assert Counter(tuple(r) for r in top_k(table, **blocks).collect()) == want
    assert "order by score desc" in topk.COMPARISON


@pytest.mark.parametrize("kind", ["normal", "ties", "unlike scales", "beyond float64", "constant", "one item"])
def test_sorted_lists(kind):
    rng = np.random.default_rng(4)
    items = np.floor(256 * rng.normal(size=(1 if kind == "one item" else 300, 8)))
    if kind == "ties":
        items = np.floor(items / 200)
    if kind == "unlike scales":
        items *= 4.0 ** np.arange(8)
    if kind == "beyond float64":
        items = np.vectorize(int, otypes=[object])(items * 2.0**30)
    if kind == "constant":
        items[:] = 5
    tie = rng.permutation(len(items))
    lists, read = topk.SortedLists(items), 0
    for turn in range(40):
        query, own = items[rng.integers(len(items))], int(rng.integers(-1, len(items)))
        if turn % 4 == 0:
            query = query * 0
        got, entries = lists.top(query, 5, own, tie)
        scores = items @ query
        want = sorted((i for i in range(len(items)) if i != own), key=lambda i: (-scores[i], tie[i]))[:5]
        assert got.tolist() == want
        if want:  # a floor drops nothing that reaches it
            floor = scores[want[len(want) // 2]]
            above = [i for i in want if scores[i] >= floor]
            assert lists.top(query, 5, own, tie, int(floor))[0].tolist()[: len(above)] == above
        read += entries
    if kind == "unlike scales":
        assert read < 0.5 * 40 * items.size  # lists that cannot decide are left unread


def test_top_k_beyond_float64(spark):
    rows = [(i, [float(2**40 + i), float(-(2**39) + 3 * i)]) for i in range(100)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(256 * x) for x in v] for i, v in rows}
    want = set()
    for q in (0, 50):
        scores = {i: min(2**63 - 1, sum(a * b for a, b in zip(v, whole[q]))) for i, v in whole.items() if i != q}
        want |= {(q, n + 1, i, scores[i]) for n, i in enumerate(sorted(scores, key=lambda i: (-scores[i], i))[:5])}
    assert {tuple(r)[::3] for r in top_k(table).collect()} == {r[::3] for r in want}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_join_near(spark, docs):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
    rows = [(100 + i, " ".join(base[:k] + [f"new{i}"] + base[k + 1 :])) for i, k in enumerate(rng.integers(0, 120, 90))]
    rows += [(i, t) for i, t, _, _ in TEXTS if i is not None]
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in join_near(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        return x if root[x] == x else find(root[x])

    links = Counter()
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[find(n)] = min(i, least.get(find(n), i))
    assert got == Counter((i, least[find(n)], links[n]) for n, (i, _) in enumerate(rows))
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 6, 7, 8, 9]


def test_join_near_by_rows_not_ids(spark):
    rng = np.random.default_rng(6)
    a, b, c, d = ([f"{x}{n}" for n in rng.integers(0, 5000, 120)] for x in "abcd")

    def near(words, k):
        return " ".join(words[:k] + ["new"] + words[k + 1 :])

    rows = [(None, near(a, 10)), (None, near(a, 60)), (None, near(a, 60)), (7, near(a, 110))]  # one class, 7
    rows += [(None, near(b, 10)), (None, near(b, 60))]  # a class without ids
    rows += [(3, " ".join(c)), (3, " ".join(d)), (8, near(c, 50)), (9, near(d, 50)), (9, near(d, 50))]  # two classes named 3
    rows += [(1, "alone one"), (20, "alone one"), (20, "alone one")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [shingles(t) for _, t in rows]
    links = [sum(i != j and 5 * len(x & y) >= 4 * len(x | y) for j, y in enumerate(sets)) for i, x in enumerate(sets)]
    classes = [7] * 4 + [None] * 2 + [3] * 5 + [1] * 3
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in join_near(table).collect())
    assert got == Counter((i, c, n) for (i, _), c, n in zip(rows, classes, links, strict=True))
    kept = Counter(tuple(r) for r in drop_near_copies(table).collect())
    first = [t for t in (rows[4], rows[5]) if t in kept]
    assert len(first) == 1 and kept == Counter([rows[3], first[0], rows[6], rows[7], rows[11]])


def test_remove_repeats(spark, docs):
    rows = [(i, (t or "").encode()) for i, t, _, _ in TEXTS]
    rank = {i: math.inf if i is None else i for i, _ in rows}
    first = {}
    for i, data in sorted(rows, key=lambda r: rank[r[0]]):
        for p in range(len(data) - 49):
            first.setdefault(data[p : p + 50], rank[i])
    want = Counter()
    for i, data in rows:
        gone = [False] * len(data)
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < rank[i]:
                gone[p : p + 50] = [True] * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        want[i, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(tuple(r) for r in remove_repeats(docs).select(names).collect()) == want
    cut = cut_repeats(docs)
    assert cut.columns == docs.columns
    assert 2 not in [r["doc_id"] for r in cut.collect()]


def test_fingerprints(spark, docs):
    got = fingerprint_documents(docs.filter("doc_id <> 7"), ranges=3).collect()
    by_id = {r["doc_id"]: r for r in got}
    order = sorted((i for i in by_id if i is not None), reverse=True)
    texts = {i: t or "" for i, t, _, _ in TEXTS}
    for i, after in zip(order, order[1:] + order[:1], strict=True):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[after][:half]
        assert by_id[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_id[i]["n_chars"] == len(texts[i])
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"]
    assert by_id[2]["near_next"] == 1.0 and by_id[3]["near_next"] > 0.9
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_toxicity_finds_the_sentence(spark):
    clean = ["the cat sat here.", "we walk home now.", "rain fell all day.", "bread and tea again."]
    rows, labels = [], []
    for i in range(400):
        parts = [clean[(i * k) % 4] for k in (1, 2, 3)]
        if i % 4 == 0:
            parts[i % 3] = "you vile creature."
        rows.append((i, " ".join(parts), "en"))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = toxicity_scores(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["doc_id"] % 4 == 0) == int(r["score"] >= 0.5)
        assert list(r["offending"]) == ([r["doc_id"] % 3] if r["doc_id"] % 4 == 0 else [])
    assert sentences(None) == [""]
    assert fit([])[-1] < 0


def test_toxicity_learns_rare_words(spark):
    clean = ["the cat sat here.", "we walk home now.", "rain fell all day.", "bread and tea again."]
    rows, labels = [], []
    for i in range(2400):
        parts = [clean[(i * k) % 4] for k in (1, 2, 3)]
        if i % 2 == 0:  # as many toxic as clean documents; every hundredth of the toxic ones by a rare word only
            parts[i % 3] = "you scoundrel." if i % 200 == 0 else "you vile creature."
        rows.append((i, " ".join(parts)))
        labels.append((i, int(i % 2 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity_scores(docs, marks).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 2 == 0) for r in got)
    # Both labels equally few.
    few = toxicity_scores(docs.filter("doc_id < 30"), marks).collect()
    assert {r["predicted"] for r in few if r["doc_id"] % 2 == 0 and r["doc_id"]} == {1}
    assert {r["predicted"] for r in few if r["doc_id"] % 2} == {0}


def test_queries_keep_their_contracts(spark):
    from shelfwise.llm.queries import QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_join_of_a_group_larger_than_a_block(spark):
    """Near copies in more than one block, each similar to some of the others only: links and classes by brute force."""
    from shelfwise.llm import chosen_path

    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(760):
        words = list(base)
        for at in rng.integers(0, 120, int(rng.integers(0, 4))):
            words[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"y{i}z{j}" for j in range(30))) for i in range(40)]
    assert len({t for _, t in rows}) > chosen_path.BLOCK
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for _, t in rows]
    links, group = Counter(), list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                group[b] = a
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in join_near(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {doc: (rows[find(i)][0], links[i]) for i, (doc, _) in enumerate(rows)}


def test_near_copies_are_not_split_below_a_root(spark, monkeypatch):
    """A root's child full of near copies is a leaf: no path is made for its members again. Others are still split."""
    from shelfwise.llm import chosen_path

    rng = np.random.default_rng(11)
    base = rng.integers(-(2**31), 2**31, chosen_path.WIDTH)

    def paths(share):
        other = rng.integers(-(2**31), 2**31, (300, chosen_path.WIDTH))
        sigs = np.where(rng.random(other.shape) < share, base, other)
        made, settle = [], chosen_path.settle

        def counted(df, name):
            out = settle(df, name)
            made.append((name, out.count()))
            return out

        monkeypatch.setattr(chosen_path, "settle", counted)
        reps = spark.createDataFrame([(i + 1, s.tolist()) for i, s in enumerate(sigs)], "sid long, sig array<int>")
        leaves = chosen_path._leaves(reps)
        monkeypatch.setattr(chosen_path, "settle", settle)
        assert leaves.filter("m < 2").isEmpty() and leaves.groupBy("key", "m").count().filter("m <> count").isEmpty()
        return [n for name, n in made if name == "paths"]

    assert len(paths(0.9)) == 1
    assert len(paths(0.4)) > 1


def test_a_signature_is_joined_once_per_set_and_level(spark, monkeypatch):
    """However many nodes hold a set, no join by sid makes more rows than there are sets."""
    from shelfwise.llm import chosen_path

    rng = np.random.default_rng(12)
    base = rng.integers(-(2**31), 2**31, chosen_path.WIDTH)
    made, kind = [], type(spark.range(0))
    join = kind.join

    def counted(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if on == "sid" and how is None:
            made.append(out.count())
        return out

    monkeypatch.setattr(kind, "join", counted)
    for share in (0.4, 0.9):  # those that are split again, and near copies
        other = rng.integers(-(2**31), 2**31, (300, chosen_path.WIDTH))
        sigs = np.where(rng.random(other.shape) < share, base, other)
        reps = spark.createDataFrame([(i + 1, s.tolist()) for i, s in enumerate(sigs)], "sid long, sig array<int>")
        chosen_path._leaves(reps).count()
    assert made and max(made) <= 300


def test_low_bits_tell_dense_nodes(spark):
    """The bits of a set in one number: a node is dense if its members agree in three quarters of the coordinates."""
    from shelfwise.llm import chosen_path

    rng = np.random.default_rng(13)
    sigs = rng.integers(-(2**31), 2**31, (40, chosen_path.WIDTH))
    near = np.where(rng.random(sigs.shape) < 0.95, sigs[0], sigs)
    rows = [(key, s.tolist()) for key, some in ((1, sigs), (2, near)) for s in some]
    marked = spark.createDataFrame(rows, "key long, sig array<int>").select("key", "sig", chosen_path._low_bits().alias("bits"))
    got = sorted((r["key"], tuple(r["sig"]), r["bits"] & (2**64 - 1)) for r in marked.collect())
    assert got == sorted((key, tuple(s), int("".join(str(h & 1) for h in s), 2)) for key, s in rows)
    assert [r["key"] for r in chosen_path._dense(marked).collect()] == [2]


def test_the_encoder_remembers_few_words():
    """Workers outlive a stage and share the executor's memory: the memos do not grow on, and words that went come back equal."""
    from shelfwise.llm.pieces import MODEL, Pieces

    with open(MODEL, "rb") as file:
        pieces = Pieces(file.read())
    texts = [" ".join(f"w{i:x}" for i in range(first, first + 5000)) for first in range(0, 300_000, 5000)]
    before = [ids.tolist() for text in texts for ids in pieces.encode_all([text])]
    assert len(pieces.memo) + len(pieces.memo.older) <= 210_000
    assert [ids.tolist() for ids in pieces.encode_all(texts[:2])] == before[:2]


def test_contents_are_sorted_some_bytes_at_a_time(monkeypatch):
    """Runs of one window each are mostly bytes: a turn takes those of few keys, and marks what one turn would."""
    from shelfwise.llm import repeats
    from shelfwise.llm.rolling import pack, unpack

    rng = np.random.default_rng(14)
    depth, keys = 200, 300
    parts = [rng.integers(97, 123, depth, dtype=np.uint8).tobytes() for _ in range(keys)]
    table = np.array([(1, 1), (2, 2)], np.int64)  # the second document has the windows of every other key of the first
    data = b"".join(parts) + b"".join(x if i % 2 else x[::-1] for i, x in enumerate(parts))
    local, number = np.repeat([0, 1], keys), np.tile(np.arange(keys), 2)
    start, size = np.tile(np.arange(keys) * depth, 2), np.full(2 * keys, depth)
    frame = pd.DataFrame({"bucket": [0], "contents": [pack(table, local, number, start, size, data)]})

    def marks():
        found = [unpack(blob) for blob in repeats._sort_contents(depth, 16)(frame)["found"]]
        return sorted(zip(*(np.concatenate(c).tolist() for c in zip(*found, strict=True)), strict=True))

    whole, sizes, rolling = marks(), [], repeats.Rolling
    assert whole == [(2, i * depth, (i + 1) * depth) for i in range(1, keys, 2)]
    monkeypatch.setattr(repeats, "CHUNK", 4096)
    monkeypatch.setattr(repeats, "Rolling", lambda content, which: sizes.append(len(content)) or rolling(content, which))
    assert marks() == whole and max(sizes) <= 4096 + 2 * depth


def test_contents_of_one_key_are_sorted_some_bytes_at_a_time(monkeypatch):
    """A common key may have more contents than all others together: it is hashed and sorted in parts, with the same marks."""
    from shelfwise.llm import repeats
    from shelfwise.llm.rolling import pack, unpack

    rng = np.random.default_rng(16)
    depth, n = 50, 2000
    size = rng.integers(depth, depth + 30, n)
    data = rng.integers(97, 99, int(size.sum()), dtype=np.uint8)
    data[np.arange(len(data)) % 64 < 60] = 97
    table = np.stack([np.arange(n), rng.integers(0, 500, n)], axis=1)
    frame = pd.DataFrame({"bucket": [0], "contents": [pack(table, np.arange(n), np.full(n, 7), np.zeros(n, np.int64), size, data.tobytes())]})
    first, want, at = {}, Counter(), np.cumsum(size) - size
    windows = [(i, s, data[at[i] + s : at[i] + s + depth].tobytes()) for i in range(n) for s in range(size[i] - depth + 1)]
    for i, _, window in windows:
        first[window] = min(first.get(window, n), table[i, 1])
    for i, s, window in windows:
        if first[window] < table[i, 1]:
            want.update((i, b) for b in range(s, s + depth))

    def marked():
        spans = [zip(*(c.tolist() for c in unpack(blob)), strict=True) for blob in repeats._sort_contents(depth, 16)(frame)["found"]]
        return {(i, b) for some in spans for i, start, end in some for b in range(start, end)}

    hashed, rolling = [], repeats.Rolling
    monkeypatch.setattr(repeats, "Rolling", lambda content, which: hashed.append(len(content)) or rolling(content, which))
    assert marked() == set(want)
    monkeypatch.setattr(repeats, "CHUNK", 4096)
    hashed.clear()
    assert marked() == set(want) and max(hashed) <= 4096 + 2 * depth


def test_runs_are_dealt_in_as_many_blobs_as_buckets(monkeypatch):
    """More text makes more buckets: were each bit of text dealt to all of them by itself, blobs would grow with the square."""
    from shelfwise.llm import repeats
    from shelfwise.llm.rolling import unpack

    rng = np.random.default_rng(15)
    texts = ["".join(map(chr, rng.integers(97, 123, n))) for n in (40, 60_000, 1_300_000, 49, 50, 700_000, 200, 600_000)]
    ids = [3, None, 7, 8, None, -5, 9, 2**62]
    rows = {"row": pa.array(range(1, 9), pa.int64()), "doc_id": pa.array(ids, pa.int64()), "text": pa.array([*texts[:-1], None])}
    batches = [pa.record_batch(rows).slice(0, 3), pa.record_batch(rows).slice(3)]

    def runs(depth=50, bits=11):
        found, blobs = [], 0
        for out in repeats._hash_runs(depth, bits)(iter(batches)):
            blobs += out.num_rows
            for bucket, blob in zip(out["bucket"].to_pylist(), out["runs"].to_pylist(), strict=True):
                names, check, rest, low, high, local, start, count = unpack(blob)
                local = np.cumsum(local)
                name = np.cumsum(names)[local]
                row = name ^ check[local].astype(np.int64) << 31
                columns = (row, name, rest, low, high, np.cumsum(start), count)
                found += [(bucket, *r) for r in zip(*(c.tolist() for c in columns), strict=True)]
        return sorted(found), blobs

    whole, blobs = runs()
    assert blobs <= 2**11
    assert sum(r[-1] for r in whole) == sum(max(0, len(t) - 49) for t in texts[:-1])
    # Held for less text, the same runs come in more blobs; a long text goes on from one to the next.
    monkeypatch.setattr(repeats, "HELD_BYTES", 1)
    again, more = runs()
    assert again == whole and more > 3 * blobs


def test_repeats_are_dealt_to_fewer_blocks_the_more_buckets_there_are():
    from shelfwise.llm.repeats import _dealing

    assert _dealing(0) == (6, 16) and _dealing(800 << 20) == (7, 400)
    assert [_dealing(gb << 30) for gb in (3, 6, 48)] == [(9, 400), (10, 768), (13, 6144)]


def test_encoding_leaves_no_encoder_behind():
    from shelfwise.llm import pieces

    with open(pieces.MODEL, "rb") as file:
        model = file.read()

    class Rows:
        sparkSession = type("Session", (), {"sparkContext": type("Context", (), {"broadcast": lambda self, v: type("Shared", (), {"value": v})})()})

        def selectExpr(self, *columns):
            return self

        def mapInArrow(self, task, schema):
            return list(task(iter([pa.record_batch({"doc_id": [1], "text": ["some words"]})])))

    library = pieces.Pieces(model)
    pieces._LOADED.clear()
    (out,) = pieces.encode_documents(Rows())
    assert out["ids"].to_pylist() == [library.encode("some words").tolist()]
    assert not pieces._LOADED


def test_labels_of_held_out_documents_change_no_score(spark):
    sf_dir = "/root/testdata/sf0.001"
    own = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    odd = spark.createDataFrame([(None, 1), (3, None), (4, 9)], "doc_id long, toxic int")
    one, two = (Counter(map(str, toxicity_scores(own, x).collect())) for x in (labels, turned.unionByName(odd)))
    assert one == two
