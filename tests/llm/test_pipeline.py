"""The corpus pipeline stage by stage: each stage on its own input, against brute force."""

import hashlib
from collections import Counter

import corpus_pipeline
import pytest

from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.pieces import MODEL
from shelfwise.llm.toxicity import toxicity_scores
from shelfwise.session import settle

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The result of each stage, as ``run`` hands it on."""
    docs = settle(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = settle(stage(spark, docs, SF_DIR))
    return found


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_and_columns(spark, stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "mix_sources", "sentencepiece"]
    for name in names[:-1]:
        assert stages[name].columns == COLUMNS, name
    ran = Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert ran == Counter((r["doc_id"], tuple(r["ids"])) for r in stages["sentencepiece"].collect())


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity_scores(stages["documents"], labels).filter("predicted = 1").collect()}
    before = _texts(stages["documents"])
    gone = {before[i] for i in toxic}
    assert toxic and _texts(stages["toxicity"]) == {i: t for i, t in before.items() if t not in gone}


def test_one_document_of_each_group_stays(stages):
    before, after = _texts(stages["toxicity"]), _texts(stages["ngram_jaccard_join"])
    ids = sorted(before)

    def shingles(text):
        words = text.split()
        return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()

    sets = {i: shingles(before[i]) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert after == {i: before[i] for i in ids if find(i) == i}
    assert len(after) < len(before)


def test_repeats_are_cut(stages):
    before, after = _texts(stages["ngram_jaccard_join"]), _texts(stages["suffix_array_dedup"])
    seen, cut = set(), 0
    for i in sorted(before):
        data = before[i].encode()
        windows = [hashlib.blake2b(data[k : k + 200], digest_size=12).digest() for k in range(len(data) - 199)]
        keep = bytearray(b"\1" * len(data))
        for k, w in enumerate(windows):
            if w in seen:
                keep[k : k + 200] = bytes(200)
        seen.update(windows)
        rest = bytes(b for b, ok in zip(data, keep, strict=True) if ok)
        cut += len(rest) < len(data)
        if len(rest) == len(data):
            assert after[i] == before[i]
        elif rest:
            # A cut inside a character leaves no part of it behind.
            assert after[i].encode() == rest or after[i] == rest.decode(errors="ignore") or after[i] == rest.decode(errors="replace")
        else:
            assert i not in after
    assert cut


def test_documents_are_repeated_as_the_mix_takes_them(stages):
    before = stages["suffix_array_dedup"]
    size = {r["doc_id"]: (r["size"], r["taken"]) for r in mix_sources(before).collect()}
    copies = Counter(r["doc_id"] for r in stages["mix_sources"].collect())
    assert all(copies[i] * n == taken for i, (n, taken) in size.items() if n)
    texts = _texts(before)
    assert all(texts[i] == t for i, t in _texts(stages["mix_sources"]).items())


def test_ids_are_those_of_the_library(stages):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    mixed = Counter((r["doc_id"], r["text"]) for r in stages["mix_sources"].collect())
    want = Counter()
    for (i, text), n in mixed.items():
        want[i, tuple(library.encode(text))] += n
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in stages["sentencepiece"].collect()) == want
