"""Extra columns with clashing names, repeated rows and very long texts, for all operators and stages."""

import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lightfold.llm import chunks, counts, jaccard, mixing, packing, ppm, preferences, search, toxicity, winnowing
from lightfold.llm.scratch import unused, written

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Names that operators give to columns of their own or of their results, and names that need quoting.
CLASHES = (
    "_id _dropped _s _l _t _token _own _text _label _kept _topic _tokens _probability gone runs run_of run cut place places source_ topic probability score predicted node root key n "
    "r row a b x y id part rank term words held hits fitted weight value want label terms removed_words component_id n_shingles piece start length offset held_out a.b c`d"
).split()


def _docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def _texts():
    rng = random.Random(4)
    words = [f"{a}{b}{d}" for a in "bdfgk" for b in "aeiou" for d in "lmnrst"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(70)
    out = [text(rng.randint(1, 80)) for _ in range(40)] + [f"{text(20)} {passage} {text(5)}" for _ in range(3)]
    return [*out, out[0], out[1] + " more", None, "", "  ", "x" * 5000]


OPERATORS = {
    "toxicity": lambda d, s: toxicity.score(d, toxicity.train(d, s.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))),
    "search": lambda d, s: search.search(search.build(d), d.where("doc_id % 10 = 0")),
    "packing": lambda d, s: packing.pack(d, BYTE).drop("sequence_id", "offset"),
    "near components": lambda d, s: jaccard.near_components(d),
    "one of each": lambda d, s: jaccard.one_of_each(d),
    "passages": lambda d, s: chunks.dedup_passages(d).withColumn("cut", F.to_json("cut")),
    "mixing": lambda d, s: mixing.mix(d),
    "counts": lambda d, s: counts.token_counts(d, PIECE),
    "fingerprints": lambda d, s: winnowing.fingerprints(d, range_bytes=2000),
    "language model": lambda d, s: ppm.lm_scores(d),
}


def _rows(df, names):
    return sorted((repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(*names).collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_change_nothing(spark, name):
    plain = _docs(spark, _texts())
    crowded = plain.select("*", *(F.lit(f"extra{i}").alias(c) for i, c in enumerate(CLASHES)))
    want = OPERATORS[name](plain, spark)
    got = OPERATORS[name](crowded, spark)
    assert _rows(got, want.columns) == _rows(want, want.columns)
    if len(got.columns) > len(want.columns):  # the operator keeps columns: those it does not add itself are as they were
        kept = [c for c in CLASHES if c not in want.columns]
        assert set(kept) <= set(got.columns)
        first = got.select(*(F.col("`" + c.replace("`", "``") + "`") for c in kept)).first()
        assert list(first) == [f"extra{CLASHES.index(c)}" for c in kept]


def test_stages_keep_extra_columns(spark, tmp_path):
    import corpus_pipeline as c

    spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = _docs(spark, _texts()).select("*", *(F.lit(f"extra{i}").alias(n) for i, n in enumerate(CLASHES) if "`" not in n))
    for name, stage in c.STAGES[:-1]:
        out = written(stage(spark, docs, str(tmp_path)), "stage")
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()
    assert c.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= docs.count()


#: Operators that give each row its own result: repeated rows have equal ones.
@pytest.mark.parametrize("name", ["toxicity", "counts", "language model", "mixing", "passages"])
def test_repeated_rows_have_rows_each(spark, name):
    docs = _docs(spark, _texts())
    twice = docs.unionByName(docs)
    got = OPERATORS[name](twice, spark)
    counted = got.groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct(F.to_json(F.struct(*(F.col(f"`{c}`") for c in got.columns)))).alias("kinds")).collect()
    assert len(counted) == docs.count() and all(r["n"] == 2 and r["kinds"] == 1 for r in counted)


def test_repeated_rows_train_once(spark):
    docs = _docs(spark, _texts())
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    one, two = (toxicity.train(d, lab) for d, lab in ((docs, labels), (docs.unionByName(docs), labels.unionByName(labels))))
    assert one.bias == two.bias and (one.known == two.known).all() and (one.weight == two.weight).all()


def test_repeated_documents_and_queries(spark):
    docs = _docs(spark, _texts())
    index = search.build(docs.unionByName(docs))
    once = docs.where("doc_id = 5")
    hits = search.search(index, once, k=4).orderBy("rank").collect()
    assert [h["doc_id"] for h in hits[:2]] == [5, 5] and hits[0]["score"] == hits[1]["score"]
    asked = search.search(index, once.unionByName(once), k=4).collect()  # one query whose terms count twice: distinct terms score
    assert sorted((h["doc_id"], round(h["score"], 9)) for h in asked) == sorted((h["doc_id"], round(h["score"], 9)) for h in hits)


def test_repeated_and_long_turns(spark):
    long = "word " * 30_000
    rows = [(1, s, 0, "user", "hi") for s in (False, True)] * 2 + [(1, False, 1, "assistant", long), (1, True, 1, "assistant", "no")]
    got = preferences.format_preferences(spark.createDataFrame(rows, "pair_id long, rejected boolean, turn int, role string, text string")).first()
    assert got["prompt_turns"] == 2 and got["prompt"].count("hi") == 2
    start, end = map(int, got["chosen_mask"].split(":"))
    assert got["chosen"][start:end] == long + "<|im_end|>\n"


def test_long_text_of_the_language_model(spark):
    from test_units import _ppm

    rng = random.Random(6)
    texts = {i: " ".join(rng.choice(["alpha", "beta", "gamma", "δέλτα"]) + str(rng.randrange(9)) for _ in range(n)) for i, n in enumerate([6000, 50, 3, 2500, 10, 20, 30, 40])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in texts.items()}
    want = _ppm(words, [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2])
    got = {r["doc_id"]: r["score"] for r in ppm.lm_scores(docs).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_sequences_are_few(spark):
    """Against best-fit decreasing by plain loops, over whole documents."""
    rng = random.Random(8)
    docs = _docs(spark, [" ".join("word" for _ in range(min(4000, int(rng.expovariate(1 / 500))))) for _ in range(400)])
    rows = packing.pack(docs, BYTE).collect()
    gaps = []
    for n in sorted((r["length"] for r in rows), reverse=True):
        fit = min((i for i, g in enumerate(gaps) if g >= n), key=gaps.__getitem__, default=None)
        if fit is None:
            gaps.append(2048 - n)
        else:
            gaps[fit] -= n
    assert len({r["sequence_id"] for r in rows}) <= len(gaps) * 1.01 + 1


def test_unused_names():
    assert unused("a", ["b"]) == "a" and unused("a", ["A", "a_"]) == "a__"
