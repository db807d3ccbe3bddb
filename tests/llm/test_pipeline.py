import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from roadcast.llm.language import fit

from .helpers import DOCS, WORD, docs, odd_rows, table
from .test_line_runs import brute_long as brute_lines
from .test_minhash import brute as brute_near
from .test_mixing import brute_targets


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    at, out = table(spark), []
    for name, f in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        f(spark, at, "").write.parquet(path)
        out.append((at, spark.read.parquet(path)))
        at = out[-1][1]
    return dict(zip([n for n, _ in cp.STAGES], out))


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_all_but_the_last_return_documents(stages):
    for name, (before, after) in stages.items():
        if name != "bpe":
            assert after.columns == before.columns and after.dtypes == before.dtypes


def test_language(spark, stages):
    before, after = stages["language_id"]
    model = fit(before)
    want = []
    for i, t in texts(before):
        lang, score = model.predict(t)
        if lang != "und" and score >= cp.LEAST_SCORE:
            want.append((i, t))
    assert sorted(texts(after)) == sorted(want)
    assert len(want) >= 0.97 * before.count()


def test_lines(stages):
    before, after = stages["line_dedup"]
    rows = texts(before)
    same = dict(rows)
    want = sorted((i, t) for i, t, _ in brute_lines(rows) if t == same[i] or WORD.search(t))
    assert sorted(texts(after)) == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_near(stages):
    before, after = stages["near_dedup"]
    want = sorted(i for i, _, c in brute_near(texts(before), 5) if c == i)
    assert sorted(i for i, _ in texts(after)) == want


def test_mixture(stages):
    before, after = stages["mixing"]
    size, words, text = Counter(), Counter(), dict(texts(before))
    for r in before.collect():
        size[r["source"]] += len(WORD.findall(r["text"]))
    per = defaultdict(list)
    for r in after.collect():
        n = len(WORD.findall(r["text"]))
        words[r["source"]] += n
        per[r["doc_id"]].append(n)
        assert text[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
    order = sorted(size)
    targets = brute_targets([size[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))])
    assert all(abs(words[s] - t) <= 1 for s, t in zip(order, targets))
    assert all(len(v) <= 2 for v in per.values())


def test_tokens(stages):
    before, after = stages["bpe"]
    lib = Tokenizer.from_file(public_tokenizers.path(cp.TOKENIZER))
    lib.no_truncation()
    lib.no_padding()
    want = Counter((i, tuple(lib.encode(t, add_special_tokens=False).ids)) for i, t in texts(before))
    got = after.collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    assert all(r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest() for r in got)


def test_odd_rows_and_empty_table(spark):
    for df in (docs(spark, odd_rows()), spark.createDataFrame([], DOCS)):
        at = df
        for name, f in cp.STAGES[:-1]:
            at = f(spark, at, "")
            assert at.columns == df.columns
            at = spark.createDataFrame(at.collect(), DOCS)
        assert cp.STAGES[-1][1](spark, at, "").count() == at.count()
