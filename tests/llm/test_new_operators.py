"""Token files, importance resampling and the filter audit against brute force, on small tables with hard cases."""
import collections
import hashlib
import heapq
import math
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oreleaf.llm import filter_audit, resampling, token_files
from oreleaf.llm.queries import END_ID, WORD_BPE
from tests.llm.test_operators import documents, plain, words_of

# A column for each name that the operators use inside.
CLASH = ("_id _ids _n _bits _marks _place _text _part _start part start block first ids_of n_tokens token_ids _words _able _range _at _above _rank rank weight "
         "n_words n_features bucket mask n _mask _text_key _salt _lid _good _toxic _least _first _groups g good toxic").split()


def hard_documents():
    more = ["It's the dog's, they'll SAY \"don't\" (x'd) 1a2b-c_d e.g. a.b,c;d", "café, café! ΣΣ İstanbul Å≠ é́ -́a", "<|endoftext|> a<|startoftext|>b",
            "tab\tnew line\x1cpart end\r\n\x00x\x7fy", "…) …'S 's ' s", "日本語.abcÿĀ \U0001f600's", "a" * 5000, "naïve " * 3000, "A B C d e", "alpha beta", "!!!...!!!"]
    rows = [(r[0], r[1], r[2]) for r in documents()] + [(100 + k, t, "fr" if k % 2 else "") for k, t in enumerate(more)]
    r = random.Random(5)
    rows += [(200 + k, words_of(900 + k % 25, 15 + k), r.choice(["en", "de", None])) for k in range(60)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    plain_rows = spark.createDataFrame(hard_documents(), "doc_id long, text string, lang string").repartition(4)
    return plain_rows.select("*", *[F.lit("clash").alias(name) for name in CLASH])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 == 0), int(i % 5 == 0)) for i in range(0, 260, 2)] + [(4, 1, None), (None, 1, 1), (6, None, 1), (6, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("_good", F.lit("clash"))


# ---- token files ------------------------------------------------------------

def library(texts):
    model = Tokenizer.from_file(WORD_BPE)
    model.encode_special_tokens = True
    return [e.ids + [END_ID] for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def written(spark, df):
    path = token_files.new_folder(spark)
    token_files.write(token_files.tokenize(df, WORD_BPE, END_ID), path)
    return path, token_files.read(spark, path)


@pytest.mark.parametrize("block_bytes", [token_files.BLOCK_BYTES, 200])
def test_files_hold_the_library_s_ids_in_order_of_id(spark, docs, monkeypatch, block_bytes):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", block_bytes)
    path, got = written(spark, docs)
    rows = sorted(got.collect(), key=lambda r: r.start)
    given = hard_documents()
    want = collections.Counter((i, tuple(ids)) for (i, _, _), ids in zip(given, library([t for _, t, _ in given])))
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.token_ids, "<u4").tolist())) for r in rows) == want
    ids = [-math.inf if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    codes = spark.read.parquet(f"{path}/codes").collect()
    assert sum(2.0 ** -r.n_bits for r in codes) <= 1 and sum(r.n for r in codes) == sum(r.n_tokens for r in rows)


def test_files_of_an_empty_table(spark, docs):
    assert written(spark, docs.limit(0))[1].count() == 0


def test_string_ids_and_rows_without_ids(spark):
    df = spark.createDataFrame([("b", None), ("a", b""), (None, np.arange(3, dtype="<u4").tobytes()), ("", np.full(1000, 7, "<u4").tobytes())], "k string, ids binary")
    path = token_files.new_folder(spark)
    token_files.write(df, path, "k", "ids")
    got = token_files.read(spark, path, "k").orderBy("start", "n_tokens", "k").collect()
    assert sorted((r.k or "", r.start, r.n_tokens) for r in got) == [("", 0, 3), ("", 3, 1000), ("a", 1003, 0), ("b", 1003, 0)]


def huffman_cost(weights):
    heap = list(weights)
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("seed", range(6))
def test_code_lengths(seed):
    r = np.random.default_rng(seed)
    weights = (r.pareto(0.6, 300) * 10 + 1).astype(np.int64)
    free = token_files.code_lengths(weights, 25)
    assert int((free * weights).sum()) == huffman_cost(weights.tolist())
    short = token_files.code_lengths(weights, 9)
    assert short.max() <= 9 and (2.0 ** -short).sum() <= 1 and int((short * weights).sum()) >= int((free * weights).sum())
    # Few symbols and a tight limit: the best of all admissible lengths.
    few = weights[:5].tolist()
    lengths = [(a, b, c, d, e) for a in range(1, 4) for b in range(1, 4) for c in range(1, 4) for d in range(1, 4) for e in range(1, 4) if sum(2.0 ** -x for x in (a, b, c, d, e)) <= 1]
    assert int((token_files.code_lengths(np.array(few), 3) * few).sum()) == min(sum(x * w for x, w in zip(ls, few)) for ls in lengths)
    with pytest.raises(ValueError):
        token_files.code_lengths(weights, 8)


def test_packing_round_trip():
    r = np.random.default_rng(1)
    ids = np.unique(r.integers(0, 2**20, 3000))
    codes = token_files.Codes(ids, token_files.code_lengths(r.integers(1, 10**6, len(ids)), 18))
    n_tokens = np.array([0, 1, 255, 256, 257, 0, 5000, 3], np.int64)
    row = r.choice(ids, n_tokens.sum()).astype("<u4")
    data, ends, marks = token_files.packed(row, n_tokens, codes.writing())
    stretches = -(-n_tokens // token_files.STEP)
    marks = marks + np.repeat(np.concatenate([[0], ends[:-1]]) * 8, stretches)
    assert (token_files.unpacked(data, marks, n_tokens, codes.reading()) == row).all()


# ---- resampling ---------------------------------------------------------------

def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_resampling(docs, target, percent=5):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = collections.Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t_ = collections.Counter(bucket(f) for t in target for f in features(t)[1])
    S, T = sum(s.values()), sum(t_.values())
    gain = [math.floor(1000 * math.log((t_[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10_000)]
    out = []
    for i, t in docs:
        words, found = features(t)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0]))
    for place, row in enumerate(able):
        row.append(place + 1 if place < percent * len(able) // 100 else None)
    return [(r[0], r[1], r[2], r[3], r[5] if len(r) == 6 else None) for r in out]


def test_resampling(spark, docs):
    target = [words_of(905, 40), None, "", words_of(910, 30).upper(), "alpha beta gamma"]
    df = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 60, 100):
        got = resampling.resample(docs, df, percent=percent).select("doc_id", "n_features", "weight", "score", "rank").collect()
        assert plain(got) == plain(brute_resampling([(i, t) for i, t, _ in hard_documents()], target, percent))


def test_resampling_of_empty_tables(spark, docs):
    target = spark.createDataFrame([("some words here",)], "text string")
    assert resampling.resample(docs.limit(0), target).count() == 0
    got = resampling.resample(docs, target.limit(0)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert plain(got) == plain(brute_resampling([(i, t) for i, t, _ in hard_documents()], []))


def test_crc_of_joined_strings():
    r = random.Random(3)
    left = [r.randbytes(r.randrange(0, 300)) for _ in range(200)]
    right = [r.randbytes(r.choice([0, 1, 2, 7, 64, 1000, 70_000])) for _ in range(200)]
    value = lambda parts: np.array([zlib.crc32(p) for p in parts], np.uint32)
    got = resampling.Crc().joined(value(left), value(right), np.array([len(p) for p in right]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right)]


# ---- filter audit ---------------------------------------------------------------

def brute_audit(rows, labels):
    rows = [(i, t or "", part or "") for i, t, part in rows]
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    fails = []
    for i, t, part in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                  "E": i is not None and i > first[t]}
        fails.append((part, {f for f in failed if failed[f]}, i in good, i in toxic))
    out = []
    for part in {p for p, *_ in fails}:
        of = [x for x in fails if x[0] == part]
        steps, shapley = [], collections.Counter()
        for order in permutations("ABCDE"):
            left = of
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                steps.append((part, "".join(order), step, len(left), len(gone), sum(f in x[1] for x in of) - len(gone), sum(x[1] == {f} for x in of),
                              sum(x[2] for x in gone), sum(x[3] for x in gone), f))
                shapley[f] += len(gone)
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return out


def test_filter_audit(docs, labels):
    got = filter_audit.audit(docs, labels)
    want = brute_audit(hard_documents(), [tuple(r)[:3] for r in labels.collect()])
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert len({w[0] for w in want}) * 600 == len(want) and filter_audit.audit(docs.limit(0), labels).count() == 0


def test_filter_audit_without_labels_and_with_hot_text(spark, labels):
    rows = [(i % 900, "same text", "en" if i % 2 else "de") for i in range(1000)] + [(None, "same text", None), (5000, "own", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = filter_audit.audit(df, labels.limit(0)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_audit(rows, []))


def test_filter_audit_never_broadcasts_labels(spark):
    ids = [*range(300), *[7] * 50, *[None] * 5]
    rows = [(i, f"text {k % 170} of {k % 3}", ["en", "de", None][k % 3]) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    marks = [(i, i % 2, i % 7 // 6) for i in [*range(20, 600), 7, 7]] + [(7, 0, 1), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(df, labels)
    for threshold in ("10m", "10g"):  # labels are far below either
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            result = got.select("*")  # planned under this threshold
            assert sorted(map(tuple, result.collect())) == sorted(brute_audit(rows, marks))
            plan = result._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "Broadcast" not in plan and plan.split("Initial Plan")[0].count("SortMergeJoin") == 1


def test_orders_by_neighbours():
    for n in range(1, 6):
        order, seen = list(range(n)), {tuple(range(n))}
        for place in filter_audit.neighbour_orders(n):
            order[place], order[place + 1] = order[place + 1], order[place]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(n)


def test_words_of_letters_go_to_the_model_and_get_the_ids_of_the_library():
    with open(WORD_BPE, encoding="utf-8") as file:
        ids = token_files.Ids(file.read())
    whole, asked = ids.model, []

    class Counted:
        def encode(self, text, **options):
            asked.append(text)
            return whole.encode(text, **options)

    ids.model = Counted()
    got = lambda texts: [np.frombuffer(x, "<u4").tolist() for x in ids.of(pa.array(texts, pa.string())).to_pylist()]
    expected = lambda texts: [whole.encode(text, add_special_tokens=False).ids for text in texts]
    plain = ["Straße élan ñandú ÿ\nABC abc", "word, word. Word word!!! été,\nété\n\nword,"]
    assert got(plain) == expected(plain)
    assert not any(letter in text for text in asked for letter in "ßéñÿw")
    odd = ["", " ", "don't 'tis it's, l'été d'un.", "été café́. İ ΣΑΣ ª5 µm 12. a1 b2, x", "<|endoftext|> </s>, œuvre Ÿ ﬁn", "\ta\r\nb.\x0b\n\nc,\x00 d" + "!" * 100]
    assert got(odd) == expected(odd)
