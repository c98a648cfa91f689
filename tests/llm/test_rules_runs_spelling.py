"""Quality rules, spelling variants and periodic runs against brute force and hard rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import quality, runs, spelling
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.words import chunks

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, n_words long, word string, n long, score double"
RNG = random.Random(5)
LETTERS = "abcdé"
TEXTS = [
    (1, " ".join(f"w{i % 97}x{i % 13}" for i in range(9000))),
    (2, "ha " * 300),
    (3, "a b c d e f g h i j k l m n"),
    (4, ""),
    (5, None),
    (6, "one\ntwo\none\n\n \none two\x0bthree\x1ffour\xa0five\n# | % $"),
    (7, "same text\n" * 3),
    (7, "same text\n" * 3),
    (7, "another one"),
    (None, "x y z x y z x y z x y z x y z end"),
    (None, None),
    (8, " ".join("".join(RNG.choices(LETTERS, k=RNG.randint(4, 7))) for _ in range(6000))),
    (9, "Itéré ItÉRÉ ITERE itere ×÷abc naïve"),
    *((100 + i, " ".join(RNG.choices("abc", k=RNG.randint(0, 90)))) for i in range(40)),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", 1, "w", 2, 0.5) for i, t in TEXTS], DOCS).repartition(5)


@pytest.fixture(scope="module")
def given(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    return rows


# Quality.


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_counts_of_the_rules(docs, given, spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    for table, rows in ((docs, TEXTS), (None, given)):
        got = quality.quality_rules(table, labels) if table else QUERIES["op11_quality_rules"](spark, SF_DIR)
        assert got.columns[:6] == ["doc_id", *quality.BASE]
        found = got.collect()
        want = Counter((i, *(c := counted(t)), c[0] < 10 or 100 * c[4] > 20 * c[0]) for i, t in rows)
        assert Counter((r["doc_id"], *(r[c] for c in quality.BASE), r["base_failed"]) for r in found) == want
        assert all(r["kept"] == (not r["base_failed"] and r["score"] >= 0.5) for r in found)


def test_counts_do_not_depend_on_chunks():
    texts = pa.array([t for _, t in TEXTS] * 2)
    for size in (1, 700, 1 << 21):
        got = np.concatenate([quality.text_statistics(c)[0] for c in chunks(texts, size)])
        assert [tuple(r) for r in got.tolist()] == [counted(t) for t in texts.to_pylist()]


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op11_quality_rules"](spark, sf_dir).collect()
    judged = [(marks[r["doc_id"]], r) for r in rows if r["doc_id"] in marks and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    bad = [r["kept"] for mark, r in judged if mark == 0]
    good = [r["kept"] for mark, r in judged if mark == 1 and not r["base_failed"]]
    assert len(bad) > 5 and sum(bad) <= 0.1 * len(bad)
    assert len(good) > 40 and sum(good) >= 0.98 * len(good)


def test_trees_are_flat_and_monotonic():
    rng = np.random.default_rng(3)
    rows = rng.random((800, 3))
    label = ((rows[:, 0] + 0.4 * np.sin(9 * rows[:, 1]) + 0.3 * rng.random(800)) > 0.8).astype(float)
    trees = quality.grow(rows, label, np.array([1, 0, -1]))
    assert ((trees.scores(rows) >= 0.5) == label).mean() > 0.85

    def walk(row):  # node by node
        z = trees.start
        for node in trees.root:
            while trees.left[node] != node:
                node = (trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right)[node]
            z += trees.value[node]
        return 1 / (1 + np.exp(-z))

    assert trees.scores(rows[:50]) == pytest.approx([walk(r) for r in rows[:50]])
    line = np.linspace(-0.5, 1.5, 300)
    for other in rng.random((30, 3)):
        for feature, sign in ((0, 1), (2, -1)):
            path = np.repeat(other[None], len(line), 0)
            path[:, feature] = line
            assert (sign * np.diff(trees.scores(path)) >= -1e-12).all()
    one = quality.grow(rows, np.ones(800), np.zeros(3, int))
    assert (one.scores(rows) > 0.99).all()
    assert quality.grow(rows[:0], label[:0], np.zeros(3, int)).scores(rows[:2]) == pytest.approx([0.5, 0.5])


def test_labels_held_out_or_unusable_change_nothing(spark, docs):
    own = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality")
    held = "crc32(cast(doc_id as string)) % 5 = 0"
    turned = labels.selectExpr("doc_id", f"if({held}, 1 - quality, quality) as quality")
    odd = spark.createDataFrame([(None, 0), (1, None), (3, 7)], "doc_id long, quality int")
    one, two = quality.train(own, labels), quality.train(own, turned.unionByName(odd))
    assert one.root.tolist() == two.root.tolist() and one.value.tolist() == two.value.tolist()
    both = quality.train(own, labels.unionByName(labels.selectExpr("doc_id", "1 - quality as quality")))
    assert abs(both.scores(np.zeros((1, len(quality.STATISTICS))))[0] - 0.5) < 0.2
    few = quality.train(own, labels, sample=5)
    assert few.depth == quality.DEPTH


def test_keep_good_filters_rows(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    own = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = quality.keep_good(docs, own, labels)
    assert kept.schema == docs.schema
    verdict = quality.judge_documents(docs, quality.train(own, labels))
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in verdict.filter("kept").collect())
    assert kept.filter("text is null or text = ''").count() == 0


def test_empty_tables(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_rules(docs.limit(0), labels).count() == 0
    assert quality.quality_rules(docs, labels).count() == len(TEXTS)
    assert runs.detect_runs(docs.limit(0)).count() == 0
    assert spelling.group_spellings(docs.limit(0)).count() == 0
    assert spelling.group_spellings(docs.filter("doc_id = 3")).count() == 0


# Runs.


def brute_runs(words):
    """(start, length, period) of all runs, by comparing every word with the one each period before."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def run_row(doc_id, text, planted):
    words = WORD.findall(text or "")
    n = len(words)
    if planted and n and doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {k for s, m, q in found for k in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    named = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listing = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    digests = (hashlib.sha256(x.encode()).hexdigest() for x in (listing, kept))
    return (doc_id, n, len(found), len(gone), *named, *digests)


def test_runs_equal_brute_force(docs, given, spark):
    for planted in (True, False):
        got = Counter(tuple(r) for r in runs.detect_runs(docs.filter("doc_id <> 8 or doc_id is null"), planted).collect())
        assert got == Counter(run_row(i, t, planted) for i, t in TEXTS if i != 8)
    small = [(i, t) for i, t in given if len(t) < 4000]
    rows = QUERIES["op13_detect_runs"](spark, SF_DIR).collect()
    assert len(rows) == len(given)
    kept = {i for i, _ in small}
    assert Counter(tuple(r) for r in rows if r["doc_id"] in kept) == Counter(run_row(i, t, True) for i, t in small)


def test_runs_of_random_and_repetitive_words():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 1 + k % 4, int(rng.integers(0, 150))) for k in range(250)]
    texts += [np.resize(rng.integers(0, 50, int(rng.integers(1, 60))), 170) for _ in range(40)]
    thue, other = "0", "1"
    for _ in range(8):
        thue, other = thue + other, other + thue
    short, long = "a", "ab"
    for _ in range(10):
        short, long = long, long + short
    texts += [np.array([ord(c) for c in t]) for t in (thue, long)] + [np.zeros(300, int)] * 3
    rows = runs.find_runs([t.astype(np.int64) for t in texts])
    for i, text in enumerate(texts):
        assert [tuple(r) for r in rows[rows[:, 0] == i, 1:].tolist()] == brute_runs(text.tolist())
    assert runs.find_runs([]).shape == (0, 4)


def test_grid_in_parts(monkeypatch):
    texts = [np.resize(np.arange(k % 9 + 1), 100 + k) for k in range(30)]
    whole = runs.find_runs(texts)
    monkeypatch.setattr(runs, "PAIRS", 50)
    assert (runs.find_runs(texts) == whole).all()


def test_extensions():
    rng = np.random.default_rng(4)
    values = np.concatenate([np.resize(rng.integers(0, 3, 37), 900), [7], rng.integers(0, 2, 600), [8]])
    index = runs.Extensions(values)
    a, b = rng.integers(0, len(values), (2, 2000))
    a, b = a[a != b], b[a != b]

    def plain(x, y):
        n = 0
        while max(x, y) + n < len(values) and values[x + n] == values[y + n]:
            n += 1
        return n

    assert index.common(a, b).tolist() == [plain(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def test_a_very_long_text():
    words = np.resize(np.random.default_rng(1).integers(0, 20000, 70_001), 150_000)
    assert runs.find_runs([words]).tolist() == [[0, 0, 150_000, 70_001]]


# Spelling.


def brute_spellings(rows):
    uses = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            uses[run] += 1
    uses = {w: n for w, n in uses.items() if len(w) >= 5 and n >= 3}
    shorter = defaultdict(set)
    for w in uses:
        for part in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            shorter[part].add(w)

    def one_apart(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    form, near = {}, {}
    for w in uses:
        candidates = set().union(*(shorter[p] for p in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}))
        near[w] = [v for v in candidates if one_apart(w, v)]
        best = min(near[w], key=lambda v: (-uses[v], v), default=None)
        form[w] = best if best and uses[best] >= 2 * uses[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), n, len(near[w]), uses[form[w]] if form[w] else None) for w, n in uses.items())


def spelled(df):
    return Counter(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_spellings_equal_brute_force(docs, given, spark):
    many = docs.unionByName(docs).unionByName(docs)
    assert spelled(spelling.group_spellings(many)) == brute_spellings(TEXTS * 3)
    got = spelled(QUERIES["op12_group_spellings"](spark, SF_DIR))
    assert got == brute_spellings(given) and len(got) > 2000


@pytest.mark.parametrize("shard", [7, 100])
def test_words_over_many_shards(spark, shard):
    rng = random.Random(8)
    words = {"".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(1500)}
    counts = {w: rng.randint(3, 40) for w in sorted(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: r for r in spelling.near_words(table, shard).collect()}
    assert set(got) == words
    for w, r in list(got.items())[:200]:
        near = [v for v in words if v != w and _distance_one(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        strong = best is not None and counts[best] >= 2 * counts[w]
        assert (r["n_near"], r["form"], r["form_n"]) == (len(near), best if strong else None, counts[best] if strong else None)


def _distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))  # noqa: B905
    return a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]


def test_index_states():
    words = sorted({"".join(random.Random(s).choices("abc", k=5 + s % 4)) for s in range(120)})
    index = spelling.Index(words)
    text = "$" + "$".join(words) + "$"
    code = {"$": 0, "a": 1, "b": 2, "c": 3}
    for pattern in ("a", "ab", "cab", "$a", "b$", "$ab", "zz"):
        for right in (True, False):
            state = index.whole(1)
            for c in pattern if right else pattern[::-1]:
                state = index.extend(state, np.array([code.get(c, -1)]), right)
                if not state[2, 0]:
                    break
            assert state[2, 0] == sum(text.startswith(pattern, i) for i in range(len(text)))


def test_roots_follow_long_paths(spark):
    rows = [(f"w{i}", f"w{i + 1}" if i < 20 else None) for i in range(21)] + [("lone", None)] + [(f"x{i}", "w0") for i in range(50)]
    got = {r["word"]: r["root"] for r in spelling.with_roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {w: "lone" if w == "lone" else "w20" for w, _ in rows}
