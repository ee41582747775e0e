"""Operators against brute force, on plain data and on the awkward: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
AWKWARD = [None, "", " \n\t ", "one", "Two words", "a b c", "é🙂 日本 x", "z" * 3000, "w " * 4000, "\x00 nul\x00 ", "tab\tline\nfeed\x0bend", "<|endoftext|> and </s>", "don't we'll 'sx"]


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))


def _texts(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.4:
            w = rng.choice(out).split()
            for _ in range(rng.randint(0, max(1, len(w) // 15))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            out.append(" ".join(w))
        else:
            out.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 120))))
    return out


def _docs(spark, texts, first=0):
    rows = [(first + i, t, "en", f"s{i % 3}", len(t or ""), "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


def _empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


# token counts


def test_counts_equal_library():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    from lightfold.llm.counts import count_tokens

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = [*AWKWARD, " ", "  a", "▁a▁", *("".join(rng.choice("ab  \n\té日🙂.,'1▁x") for _ in range(rng.randint(0, 60))) for _ in range(300))]
    size, tokens = count_tokens(pa.array(texts), path)
    assert tokens.tolist() == [len(library.encode(t or "")) for t in texts]
    assert size.tolist() == [len((t or "").encode()) for t in texts]


def test_counts_query(spark):
    import public_tokenizers

    from lightfold.llm.counts import token_counts

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = token_counts(_docs(spark, AWKWARD), path, limit=2).collect()
    assert len(rows) == len(AWKWARD) and all(r["over_limit"] == (r["n_tokens"] > 2) for r in rows)
    assert token_counts(_empty(spark), path).count() == 0


# packing


def test_ids_equal_library():
    import public_tokenizers

    from lightfold.llm.packing import encoder

    e = encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    texts = [*AWKWARD, "l'r're", "I'm 'm! '' 's", "a  b   c\n\n", *("".join(rng.choice("abstmdrevl  \n\té日🙂.,''1 ²") for _ in range(rng.randint(0, 30))) for _ in range(1500))]
    for t, ids in zip(texts, e.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids, t


@pytest.mark.parametrize("seed", [1, 2])
def test_plan_uses_each_piece_once(seed):
    from lightfold.llm.packing import lines, plan

    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.geometric(0.004, 5000), 2048)
    histogram = np.bincount(lengths, minlength=2049)
    found = plan(histogram)
    used = np.zeros(2049, int)
    for own, times in found:
        assert sum(own) <= 2048
        np.add.at(used, own, times)
    assert (used == histogram).all()
    least = math.ceil(lengths.sum() / 2048)
    assert sum(t for _, t in found) <= least * 1.01 + 2
    ranks = defaultdict(int)
    for n, low, high, _, _ in lines(found):
        assert ranks[n] == low
        ranks[n] = high
    assert plan(np.zeros(2049, int)) == []


def test_nnls():
    from lightfold.llm.packing import nnls

    columns = np.array([[3, 1, 0], [2, 2, 0], [2, 1, 1], [1, 1, 0]])
    x = nnls(columns, np.array([5.0, 3.0, 2.0]))
    a = np.array([[1, 0, 2, 2], [0, 2, 1, 0], [1, 0, 0, 0]], float)
    slope = a.T @ (np.array([5.0, 3.0, 2.0]) - a @ x)
    assert (x >= 0).all() and (slope <= 1e-6).all() and abs(slope @ x) < 1e-6


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from lightfold.llm.packing import pack

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*AWKWARD, *_texts(60)] * 2
    rows = pack(_docs(spark, texts).repartition(3), path).collect()
    library = Tokenizer.from_file(path)
    at = defaultdict(list)
    by = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
        by[r["doc_id"]].append(r)
    for places in at.values():
        upto = 0
        for offset, n in sorted(places):
            assert offset == upto
            upto += n
        assert upto <= 2048
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 2048 for r in own[1:])
        for r in own:
            assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    assert pack(_empty(spark), path).count() == 0


# near-duplicates


def _components(texts, k, num):
    sets = []
    for t in texts:
        w = _words(t)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize(("k", "num", "block"), [(3, 90, 1_500_000), (5, 80, 1_500_000), (2, 50, 700), (3, 100, 1_500_000)])
def test_near_components(spark, k, num, block):
    from lightfold.llm.jaccard import near_components

    texts = [*AWKWARD, *_texts(150, seed=k)]
    rows = near_components(_docs(spark, texts), k=k, num=num, den=100, block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == _components(texts, k, num)


@pytest.mark.parametrize(("flush", "block"), [(500_000, 400_000), (3000, 2000)])
def test_large_group_of_unlinked_near_copies(spark, monkeypatch, flush, block):
    """Hundreds of texts share a passage of most of their words without being linked; some have linked partners, also far apart."""
    from lightfold.llm import jaccard

    monkeypatch.setattr(jaccard, "FLUSH", flush)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(300):
        own = [word() for _ in range(rng.randint(8, 14))]
        texts.append(" ".join([*own[:4], *passage, *own[4:]]))
    for _ in range(60):  # chains of linked texts within the group
        w = rng.choice(texts).split()
        w[rng.choice([0, 1, len(w) - 1])] = word()
        texts.append(" ".join(w))
    rng.shuffle(texts)
    want = _components(texts, 5, 80)
    rows = jaccard.near_components(_docs(spark, texts).repartition(3), k=5, num=80, den=100, block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    assert 60 < len({c for _, c in want.values()}) < len(texts) - 30


def test_documents_meet_below_pivots_of_their_own_keys(spark, monkeypatch):
    """In a large group of unlinked near copies no document is entered below a pivot that none of its keys has."""
    import pyarrow as pa

    from lightfold.llm import jaccard
    from lightfold.llm.textops import shingle_sets

    monkeypatch.setattr(jaccard, "FLUSH", 1000)
    kept = {}
    keep = jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name, *a: kept.setdefault(name, []).append(keep(df, name, *a)) or kept[name][-1])
    monkeypatch.setattr(jaccard, "settled", lambda make, name: make())
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(300):
        own = [word() for _ in range(rng.randint(8, 14))]
        texts.append(" ".join([*own[:4], *passage, *own[4:]]))
    rows = jaccard.near_components(_docs(spark, texts).repartition(3), k=5, num=80, den=100).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == _components(texts, 5, 80)
    holders = {}
    for i, s in enumerate(shingle_sets(pa.array(texts), 5)):
        for key in jaccard.Bands(80, 100).keys(s).tolist():
            holders.setdefault(key, []).append(i)
    allowed = {(h[0], i) for h in holders.values() if len(h) > 1 for i in h}
    met = [(r["pivot"], r["node"]) for r in kept["below"][0].collect()]
    assert len(met) == len(set(met)) > 300 and set(met) <= allowed


def test_near_edges(spark):
    from lightfold.llm.jaccard import near_components, one_of_each

    t = "a b c d e f g h"
    docs = spark.createDataFrame([(5, t, 1), (5, t, 2), (3, t.upper(), 3), (None, t, 4), (9, None, 5)], "doc_id long, text string, component_id int")
    rows = near_components(docs).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(3, 3), (5, 3), (9, 9)]
    kept = one_of_each(docs).collect()
    assert sorted(r["component_id"] for r in kept) == [3, 4, 5]
    assert near_components(_empty(spark)).count() == 0


def test_sketches_never_exceed_difference():
    from lightfold.llm.jaccard import Bands, parity

    rng = np.random.default_rng(4)
    bands = Bands(80, 100)
    for n in (8, 40, 300):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.r_[a[: int(len(a) * 0.95)], rng.integers(0, 1 << 63, 2).astype(np.uint64)])
        apart = len(np.setxor1d(a, b))
        assert np.bitwise_count(parity(a) ^ parity(b)).sum() <= apart
        if apart <= bands.most(len(a), len(b)):
            assert len(np.intersect1d(bands.keys(a), bands.keys(b)))


# passages


def _longest_repeats(rows, least):
    """Words of each text that lie in a passage of ``least`` words or more that an earlier text, or an earlier place, holds."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in rows]
    seen, out = {}, []
    for i, w in enumerate(words):
        for p in range(len(w) - least + 1):
            seen.setdefault(tuple(w[p : p + least]), (i, p))
    for i, w in enumerate(words):
        covered = set()
        for p in range(len(w) - least + 1):
            if seen[tuple(w[p : p + least])] != (i, p):
                covered.update(range(p, p + least))
        out.append(covered)
    return out


@pytest.mark.parametrize("flush", [500_000, 300])
def test_passages(spark, monkeypatch, flush):
    from lightfold.llm import chunks

    monkeypatch.setattr(chunks, "FLUSH", flush)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randint(50, 90)) for _ in range(60)]
    line = text(12)
    rows = []
    for p in passages:
        for _ in range(3):
            rows.append(f"{text(rng.randint(0, 60))}\n{p}\n{text(rng.randint(1, 60))}")
    rows += [f"{text(80)}\n{line}\n{text(40)}" for _ in range(40)]
    rows += [f"{text(30)} {p} {text(10)} {p}" for p in passages[:3]]  # twice in a text
    awkward = len(rows)
    rows += AWKWARD
    found = {r["doc_id"]: r for r in chunks.dedup_passages(_docs(spark, rows).repartition(4)).collect()}
    assert len(found) == len(rows)
    want = _longest_repeats(rows, 50)
    for i in range(awkward):  # to the word
        kept = [w for p, w in enumerate(rows[i].split()) if p not in want[i]]
        assert found[i]["text"].split() == kept and found[i]["removed_words"] == len(want[i])
        assert found[i]["removed_words"] or found[i]["text"] == rows[i]
    for i, r in found.items():
        assert r["removed_words"] <= len(want[i])
        if r["removed_words"]:
            cut = "".join(rows[i][a:b] for a, b in zip([0, *(s["end"] for s in r["cut"])], [*(s["start"] for s in r["cut"]), None], strict=True))
            assert cut == r["text"] and sum(len(rows[i][s["start"] : s["end"]].split()) for s in r["cut"]) == r["removed_words"]
    assert chunks.dedup_passages(_empty(spark)).count() == 0


def test_repeated_rows_keep_text(spark):
    from lightfold.llm.chunks import dedup_passages

    t = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, t, "k"), (1, t, "k"), (2, t, "k"), (None, t, "k")], "doc_id long, text string, cut string")
    rows = dedup_passages(docs).collect()
    assert sorted((r["doc_id"] or 0, len(r["text"] or "") == len(t)) for r in rows) == [(0, True), (1, True), (1, True), (2, False)]


# fingerprints


def test_winnowing_against_brute_force():
    from lightfold.llm.winnowing import winnow

    rng = random.Random(6)
    for _ in range(200):
        t = "".join(rng.choice("abé🙂") for _ in range(rng.randint(0, 60)))
        k, w = rng.randint(1, 6), rng.randint(1, 12)
        grams = [int(winnow(t[i : i + k], k, 1)[0][0]) for i in range(max(1, len(t) - k + 1))] if t else []
        want = []
        for i in range(max(1, len(grams) - w + 1) if grams else 0):
            window = grams[i : i + w]
            place = (min(window), i + max(j for j, h in enumerate(window) if h == min(window)))
            if not want or want[-1] != place:
                want.append(place)
        h, p = winnow(t, k, w)
        assert list(zip(h.tolist(), p.tolist(), strict=True)) == want


def test_fingerprints(spark):
    from lightfold.llm.winnowing import edited, fingerprints, likeness, winnow, written_form

    texts = [*AWKWARD, *_texts(40)]
    docs = _docs(spark, texts, first=-5)
    rows = {r["doc_id"]: r for r in fingerprints(docs, range_bytes=3000).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % len(texts)] or ""
        new, r = edited(t, after), rows[i - 5]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == written_form(*winnow(t)) and r["edited_fingerprint"] == written_form(*winnow(new))
        assert r["near_edited"] == likeness(winnow(t)[0], winnow(new)[0]) and r["near_next"] == likeness(winnow(t)[0], winnow(after)[0])
    assert fingerprints(_empty(spark)).count() == 0
    twice = fingerprints(spark.createDataFrame([(1, "b" * 90, 0), (1, "a" * 80, 0), (None, "c", 0)], "doc_id long, text string, r int")).collect()
    assert sorted(r["n_chars"] for r in twice) == [80, 90]


@pytest.mark.parametrize("ids", [[-(2**63), -1, 0, 2**63 - 1], [*range(1000, 1060), 10**15, -(10**15)]])
def test_fingerprints_of_clumped_and_extreme_ids(spark, ids):
    from lightfold.llm.winnowing import edited, fingerprints, winnow, written_form

    texts = dict(zip(ids, _texts(len(ids), seed=2), strict=True))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in fingerprints(docs, range_bytes=1500).collect()}
    order = sorted(ids)
    assert sorted(rows) == order
    for i, after in zip(order, [*order[1:], order[0]], strict=True):
        assert rows[i]["edited_fingerprint"] == written_form(*winnow(edited(texts[i], texts[after])))


# toxicity


@pytest.mark.parametrize("neutral", [False, True])
def test_toxicity_learns_pairs(neutral):
    """At the production settings: two terms are toxic together, or (neutral) exactly one of them is, so that none tells anything alone."""
    from lightfold.llm import toxicity as x

    rng = random.Random(7)
    noise = [f"word{i}" for i in range(300)]

    def text(*marks):
        w = [rng.choice(noise) for _ in range(20)] + list(marks)
        rng.shuffle(w)
        return " ".join(w)

    cases = ((("stone",), 0), (("zebra",), int(neutral)), (("quilt",), int(neutral)), (("zebra", "quilt"), int(not neutral)))
    texts, labels = [], []
    for _ in range(1500):
        for marks, y in cases:
            texts.append(text(*marks))
            labels.append(y)
    y = np.array(labels)
    t, ends = x.terms(pa.array(texts))
    machine = x.fit(t[: ends[4999]], ends[:5000], y[:5000])
    later, after = x.terms(pa.array(texts[5000:]))
    right = (machine.scores(later, after) >= 0.5) == (y[5000:] == 1)
    assert right.mean() > 0.97


def test_toxicity_score_against_brute_force():
    from lightfold.llm import toxicity as x

    rng = np.random.default_rng(3)
    texts = [*AWKWARD, *_texts(30)]
    flat_terms, ends = x.terms(pa.array(texts))
    known = np.unique(flat_terms)[::2]
    machine = x.Machine(-0.3, known, rng.normal(0, 0.3, len(known)), rng.normal(0, 0.2, (len(known), 3)))
    place = {int(t): k for k, t in enumerate(known)}
    for score, a, b in zip(machine.scores(flat_terms, ends), [0, *ends], ends, strict=False):
        own = [place[int(t)] for t in flat_terms[a:b] if int(t) in place]
        raw = -0.3 + sum(machine.weight[i] for i in own) + sum(machine.factor[i] @ machine.factor[j] for n, i in enumerate(own) for j in own[:n])
        assert score == pytest.approx(1 / (1 + math.exp(-raw)), abs=1e-9)


def test_toxicity_edges(spark):
    from lightfold.llm import toxicity as x

    docs = _docs(spark, [*AWKWARD, *(f"plain text number {i} " + ("vile" if i % 2 else "") for i in range(200))])
    labels = spark.createDataFrame([*((len(AWKWARD) + i, i % 2) for i in range(200)), (None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    rows = x.score(docs, x.train(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    level = x.Machine(0.0, np.zeros(0, np.uint32), np.zeros(0), np.zeros((0, 2)))
    assert {r["predicted"] for r in x.score(docs, level, threshold=0.5).collect()} == {1}
    plain = {r["doc_id"]: r["predicted"] for r in rows}
    assert all(plain[len(AWKWARD) + i] == i % 2 for i in range(200))
    nothing = x.train(docs, labels.where("false"))
    assert {r["score"] for r in x.score(docs, nothing).collect()} == {0.5}
    assert x.score(_empty(spark), nothing).count() == 0


# mixing


def test_rake_meets_targets():
    from lightfold.llm.mixing import rake

    rng = np.random.default_rng(8)
    cells = np.array([(a, b, c) for a in range(4) for b in range(3) for c in range(2)])
    weight = rng.integers(50, 100, len(cells)).astype(float)
    targets = [{0: 0.3, 1: 0.25, 2: 0.25, 3: 0.2}, {0: 0.4, 1: 0.3, 2: 0.3}, {}]
    p = rake(cells, weight, targets, 0.5)
    kept = weight * p
    assert kept.sum() == pytest.approx(weight.sum() / 2) and (p <= 1).all()
    for k, told in enumerate(targets):
        for v, share in told.items():
            assert kept[cells[:, k] == v].sum() / kept.sum() == pytest.approx(share, abs=1e-6)


def test_mixing(spark, monkeypatch):
    from lightfold.llm import mixing

    texts = [*AWKWARD, *_texts(300)]
    docs = _docs(spark, texts).withColumnRenamed("score", "topic")
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts) and all(0 <= r["_probability"] <= 1 for r in rows)
    assert [r["_tokens"] for r in sorted(rows, key=lambda r: r["doc_id"])] == [len(_words(t)) for t in texts]
    few = docs.limit(60).cache()
    monkeypatch.setattr(mixing, "DRIVER_CELLS", 0)
    again = {r["doc_id"]: r["_probability"] for r in mixing.mix(few).collect()}
    monkeypatch.setattr(mixing, "DRIVER_CELLS", 10**6)
    for r in mixing.mix(few).collect():
        assert again[r["doc_id"]] == pytest.approx(r["_probability"], abs=1e-9)
    assert mixing.mix(_empty(spark)).count() == 0
    odd = spark.createDataFrame([(None, "a b", None, None), (1, None, "s", "l"), (1, None, "s", "l")], "doc_id long, text string, source string, lang string")
    assert mixing.mix(odd).count() == 3


def test_mixing_against_brute_force(spark):
    """Tokens, topics, cells, targets and kept rows computed anew, word by word; ties of topic words go to the least hash."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    from lightfold.llm import mixing
    from lightfold.llm.textops import prefix_hash, span_hash

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    texts = [*AWKWARD, *_texts(120), "equal words tied tied words equal"]

    def word_hash(w):
        b = np.frombuffer(w.encode(), np.uint8)
        return int(span_hash(prefix_hash(b), np.array([0]), np.array([len(b)]))[0])

    def topic(t):
        long = Counter(w for w in _words(t) if len(w.encode()) >= 5)
        return min(((-n, word_hash(w) >> 20) for w, n in long.items()), default=(0, -1))[1]

    rows = {r["doc_id"]: r for r in mixing.mix(_docs(spark, texts), tokenizer=path).collect()}
    weights, cells = {}, {}
    for i, t in enumerate(texts):
        h = topic(t)
        cells[i] = (f"s{i % 3}", "en", str(h % 8 if h >= 0 else -1))
        weights[i] = len(library.encode(t or ""))
        assert rows[i]["_tokens"] == weights[i] and rows[i]["_topic"] == int(cells[i][2])
    total = sum(weights.values())
    mass = defaultdict(float)
    for i, c in cells.items():
        mass[c] += weights[i] / total
    wants = []
    for k in range(3):
        now = defaultdict(float)
        for c, w in mass.items():
            now[c[k]] += w
        scale = sum(x**0.8 for x in now.values() if x)
        wants.append({v: min(x**0.8 / scale * 0.7, x) if x else 0.0 for v, x in now.items()})
    p = dict.fromkeys(mass, 0.7)
    for _ in range(300):
        for k in range(3):
            now = defaultdict(float)
            for c in p:
                now[c[k]] += mass[c] * p[c]
            p = {c: min(1.0, q * (wants[k][c[k]] / now[c[k]] if now[c[k]] else 1)) for c, q in p.items()}
    for i, r in rows.items():
        assert r["_probability"] == pytest.approx(p[cells[i]], abs=1e-9)
    assert {r["_kept"] for r in rows.values()} == {True, False}


def test_mixing_of_many_sources(spark):
    from lightfold.llm import mixing

    docs = spark.range(12_000).selectExpr("id AS doc_id", "concat('word', id % 7, ' some text') AS text", "concat('s', id) AS source", "'en' AS lang")
    told = {"source": {f"s{i}": 1.0 / (1 + i % 5) for i in range(12_000)}}
    rows = mixing.mix(docs, targets=told).collect()
    assert len(rows) == 12_000 and all(0 < r["_probability"] <= 1 for r in rows)


# language model


def _ppm(words, train, order=5):
    seen = defaultdict(Counter)

    def symbols(w):
        return b"\0" * order + b"".join(x.encode() + b" " for x in w) + b"\0"

    for i in train:
        b = symbols(words[i])
        for p in range(order, len(b)):
            for k in range(order + 1):
                seen[b[p - k : p]][b[p]] += 1
    out = {}
    for i, w in words.items():
        b, s = symbols(w), 0.0
        for p in range(order, len(b)):
            left = set()
            for k in range(order, -1, -1):
                own = {x: n for x, n in seen.get(b[p - k : p], {}).items() if x not in left}
                if own:
                    total = sum(own.values()) + len(own)
                    if b[p] in own:
                        s += math.log10(own[b[p]] / total)
                        break
                    s += math.log10(len(own) / total)
                    left |= set(own)
            else:
                s -= math.log10(256 - len(left))
        out[i] = s
    return out


@pytest.mark.parametrize("common", [1_000_000, 50])
def test_lm_scores(spark, monkeypatch, common):
    from lightfold.llm import ppm

    monkeypatch.setattr(ppm, "COMMON", common)
    texts = dict(enumerate([*AWKWARD[:7], "\x00 nul\x00 ", "z" * 50, *_texts(50)]))
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, words string")
    rows = {r["doc_id"]: r for r in ppm.lm_scores(docs).collect()}
    words = {i: _words(t) for i, t in texts.items()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for i in train for w in words[i])
    counts["\n"] = len(train)
    n, v = sum(counts.values()), len(counts)
    want = _ppm(words, train)
    for i, w in words.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (i not in train, len(w) + 1, n)
        assert r["n_known"] == sum(counts[x] > 0 for x in [*w, "\n"])
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, "\n"]), abs=1e-8)
        assert r["score"] == pytest.approx(want[i], abs=1e-6)
    assert ppm.lm_scores(_empty(spark)).count() == 0


def test_lm_scores_with_more_grams_than_sent(spark, monkeypatch):
    from lightfold.llm import ppm

    texts = dict(enumerate([*AWKWARD[:7], "z" * 50, *_texts(50), "Q once # only", "Q once # onlz"]))
    words = {i: _words(t) for i, t in texts.items()}
    want = _ppm(words, [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for nodes in (300, 0):
        monkeypatch.setattr(ppm, "NODES", nodes)
        got = {r["doc_id"]: r["score"] for r in ppm.lm_scores(docs).collect()}
        assert got == pytest.approx(want, abs=1e-6)


# search


@pytest.mark.parametrize(("asked", "groups"), [(2_000_000, 32), (300, 1)])
def test_search_is_exact(spark, monkeypatch, asked, groups):
    from lightfold.llm import search

    monkeypatch.setattr(search, "DOCUMENTS", 40)
    monkeypatch.setattr(search, "ASKED", asked)
    monkeypatch.setattr(search, "GROUPS", groups)
    texts = [*AWKWARD, *_texts(160)]
    docs = _docs(spark, texts)
    bags = [Counter(_words(t)) for t in texts]
    n, df = len(texts), Counter(w for b in bags for w in b)
    size = [sum(b.values()) for b in bags]
    mean = sum(size) / n
    index = search.build(docs)
    got = defaultdict(list)
    for r in search.search(index, docs.where("doc_id % 10 = 4"), k=7).collect():
        got[r["query_id"]].append((r["rank"], r["doc_id"], r["score"]))
    for q in range(4, n, 10):
        idf = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) for w in bags[q]}
        scores = {i: sum(idf[w] * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for w in idf if w in b) for i, b in enumerate(bags)}
        top = sorted((-s, i) for i, s in scores.items() if s > 0)[:7]
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, len(top) + 1))
        assert [s for _, _, s in own] == pytest.approx([-s for s, _ in top])
    assert search.search(search.build(_empty(spark)), docs).count() == 0
    assert search.search(index, _empty(spark)).count() == 0


def test_registered_search_takes_all_terms(spark):
    from lightfold.llm.queries import op2_topk_search

    sf = "/root/testdata/sf0.001"
    bags = {i: Counter(_words(t)) for i, t in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    n, df = len(bags), Counter(w for b in bags.values() for w in b)
    size = {i: sum(b.values()) for i, b in bags.items()}
    mean = sum(size.values()) / n
    got = defaultdict(list)
    for r in op2_topk_search(spark, sf).collect():
        got[r["query_id"]].append((r["rank"], r["doc_id"], r["score"]))
    asked = [i for i, b in bags.items() if i % 100 == 0 and b]
    assert any(len(bags[q]) > 16 for q in asked)
    for q in asked:
        idf = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) for w in bags[q]}
        scores = {i: sum(idf[w] * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for w in idf if w in b) for i, b in bags.items()}
        top = sorted(-s for s in scores.values() if s > 0)[:10]
        assert [s for _, _, s in sorted(got[q])] == pytest.approx([-s for s in top])
        assert all(s == pytest.approx(scores[d]) for _, d, s in got[q])


def test_best_of_all_against_wand():
    from lightfold.llm.search import BLOCK, best_of_all, block_max_wand

    rng = np.random.default_rng(4)
    for k in (1, 9, 700):
        plain, totals = [], np.zeros(600)
        for _ in range(4):
            places = np.flatnonzero(rng.random(600) < 0.4)
            adds = rng.integers(1, 5, len(places)).astype(float)
            totals[places] += adds
            plain.append((places.tolist(), adds.tolist(), [float(adds[i : i + BLOCK].max()) for i in range(0, len(adds), BLOCK)], float(adds.max())))
        at, scores = best_of_all(totals, k)
        assert list(zip(scores.tolist(), at.tolist(), strict=True)) == block_max_wand(plain, k)
        assert [x for x in block_max_wand(plain, k, 9.0) if x[0] >= 9] == [x for x in block_max_wand(plain, k) if x[0] >= 9]


@pytest.mark.parametrize("few", [0, 16, 10**9])
def test_both_ways_of_search_agree(spark, monkeypatch, few):
    from lightfold.llm import search

    monkeypatch.setattr(search, "FEW", few)
    monkeypatch.setattr(search, "DOCUMENTS", 70)
    monkeypatch.setattr(search, "GROUPS", 2)
    docs = _docs(spark, [*AWKWARD, *_texts(150)] * 2)  # every score is tied
    got = sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in search.search(search.build(docs), docs.where("doc_id % 20 = 14"), k=5).collect())
    monkeypatch.setattr(search, "FEW", 3)
    again = sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in search.search(search.build(docs), docs.where("doc_id % 20 = 14"), k=5).collect())
    assert got == again and len(got) > 20


def test_wand_against_all():
    from lightfold.llm.search import BLOCK, block_max_wand

    rng = np.random.default_rng(9)
    for _ in range(60):
        lists, total = [], Counter()
        for _ in range(rng.integers(1, 6)):
            places = np.flatnonzero(rng.random(600) < rng.uniform(0.02, 0.7)).tolist()
            adds = rng.integers(1, 5, len(places)).astype(float).tolist()
            for p, s in zip(places, adds, strict=True):
                total[p] += s
            blocks = [max(adds[i : i + BLOCK]) for i in range(0, len(adds), BLOCK)]
            lists.append((places, adds, blocks, max(adds, default=0.0)))
        assert block_max_wand(lists, 9) == sorted(((s, p) for p, s in total.items()), key=lambda x: (-x[0], x[1]))[:9]


# chat


def test_preferences(spark):
    from lightfold.llm.preferences import format_preferences

    rows = [
        (1, False, 0, "user", "hi"), (1, False, 1, "assistant", "yes"), (1, True, 0, "user", "hi"), (1, True, 1, "assistant", "no"), (1, True, 2, "user", "?"),
        (2, False, 0, "user", "same"), (2, True, 0, "user", "same"), (3, False, 0, "user", "alone"), (None, False, 0, "user", "x"),
        (4, False, None, None, None), (4, True, 0, "assistant", "<|im_end|>"),
    ]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "pair_id long, rejected boolean, turn int, role string, text string, prompt string")
    got = {r["pair_id"]: r for r in format_preferences(turns).collect()}
    assert sorted(got) == [1, 2, 4]
    a = got[1]
    assert (a["prompt_turns"], a["prompt"]) == (1, "<|im_start|>user\nhi<|im_end|>\n")
    assert a["chosen"] == "<|im_start|>assistant\nyes<|im_end|>\n"
    start, end = map(int, a["chosen_mask"].split(":"))
    assert a["chosen"][start:end] == "yes<|im_end|>\n"
    start, end = map(int, a["rejected_mask"].split(":"))
    assert a["rejected"][start:end] == "no<|im_end|>\n"
    assert (got[2]["prompt_turns"], got[2]["chosen"], got[2]["rejected"], got[2]["chosen_mask"]) == (1, "", "", "")
    assert "<| im_end|>" in got[4]["rejected"] and format_preferences(turns.where("false")).count() == 0


def test_preferences_against_sql(spark):
    import duckdb

    from lightfold.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    told = con.sql(queries.ORACLES["op3_preferences"])
    df = queries.QUERIES["op3_preferences"](spark, sf)
    assert sorted(df.columns) == sorted(told.columns)
    assert sorted(tuple(r) for r in df.select(*told.columns).collect()) == sorted(told.fetchall())
