"""Token alignment, spelling variants and language identification against plain Python."""

import hashlib
import random
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest

from roadpulse.llm import alignment, language, spelling
from roadpulse.llm.packing import tokenizer_path

PATHS = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    "plain words, and <|endoftext|> </s> as text", "▁ low line", "a▁b", "  two  spaces\n\n tabs\t\tx ", " ", "\x00 nul\x00", "émoji 😀😀👩‍👩‍👧 ü  ",
    "😀" * 300, "日本語のテキスト " * 20, "a" * 5000, " no　break\x85x\x1cy", "\r\n", "the the the the", "ﬁ ﬂ ㎏ Å", "x﻿y", "ends ", None, "", "1234567890 " * 30,
]


def plain_alignment(texts):
    """Rows of whole texts, both tokenizers run on the whole, groups as the common ends of both."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    both = alignment.tokens(*PATHS)
    pair_docs, held, rows = Counter(), [], []
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        joined = [b"".join(t[i] for i in ids) for t, ids in ((both.bytes_a, a), (both.bytes_b, b))]
        if not text or joined != [(" " + text).encode()] * 2:
            a, b = [], []
        ends = [np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((both.bytes_a, a), (both.bytes_b, b))]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side, ids in enumerate((a, b)):
            for end, i in zip(ends[side], ids):
                groups[bisect_left(cuts, end)][side].append(i)
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        pair_docs.update(links.keys())
        held.append(links)
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((len(a), len(b), len(groups), sum(links.values()), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    best = {}
    for (a, _), n in pair_docs.items():
        best[a] = max(best.get(a, 0), n)
    return [
        (*row[:4], sum(n for p, n in links.items() if pair_docs[p] == best[p[0]]), sum(n * pair_docs[p] for p, n in links.items()), row[4])
        for row, links in zip(rows, held)
    ], pair_docs, best


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("chunk_pairs", [alignment.CHUNK_PAIRS, 300])
def test_alignment_matches_plain(spark, odd, chunk_pairs):
    docs = [(r.doc_id, r.text) for r in odd.collect()] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    want, pair_docs, best = plain_alignment([t for _, t in docs])
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = alignment.aligned(frame, *PATHS, chunk_pairs).collect()
    assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in got) == Counter((i, *w) for (i, _), w in zip(docs, want))
    assert sum(w[0] > 0 for w in want) > 20 and any(w[0] == 0 for w in want)
    found = {(r.a, r.b, r.n) for r in alignment.translations(frame, *PATHS).collect()}
    assert found == {(a, b, n) for (a, b), n in pair_docs.items() if n == best[a]}


def test_alignment_query_on_the_small_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want, _, _ = plain_alignment([t for _, t in docs])
    got = alignment.op11_token_alignment(spark, sf_dir).collect()
    assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in got) == Counter((i, *w) for (i, _), w in zip(docs, want))


def test_alignment_of_an_empty_table(odd, none):
    assert alignment.aligned(none, *PATHS).count() == 0
    assert alignment.aligned(odd, *PATHS).columns == ["doc_id", *COLUMNS]


def test_run_skipping_finds_the_common_ends():
    draw = random.Random(7)
    for trial in range(400):
        n = draw.choice([1, 2, 5, 40, 300])
        common = draw.choice([0.05, 0.5, 0.95, 1.0])
        ends_a = sorted({n * 3, *(i for i in range(1, n * 3) if draw.random() < 0.5)})
        ends_b = sorted({n * 3, *(i for i in ends_a if draw.random() < common), *(i for i in range(1, n * 3) if draw.random() < (1 - common) / 2)})
        sizes_a, sizes_b = alignment.group_sizes(np.array(ends_a), np.array(ends_b))
        shared = sorted(set(ends_a) & set(ends_b))
        assert np.array(ends_a)[np.cumsum(sizes_a) - 1].tolist() == shared == np.array(ends_b)[np.cumsum(sizes_b) - 1].tolist(), trial
    empty = alignment.group_sizes(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert [len(s) for s in empty] == [0, 0]


def test_links_of_large_groups_are_counted(monkeypatch):
    draw = np.random.default_rng(3)
    sizes_a, sizes_b = draw.integers(1, 9, 60), draw.integers(1, 9, 60)
    a, b, text = draw.integers(0, 5, sizes_a.sum()), draw.integers(0, 5, sizes_b.sum()), np.repeat(np.arange(4), 15)
    want = alignment.linked_pairs(a, b, sizes_a, sizes_b, text)
    monkeypatch.setattr(alignment, "LISTED", 6)
    assert all((x == y).all() for x, y in zip(alignment.linked_pairs(a, b, sizes_a, sizes_b, text), want))
    assert want[2].sum() == (sizes_a * sizes_b).sum()


def test_packed_pairs_round_trip():
    at, times = np.array([0, 3, 4, 70000, 1 << 24]), np.array([1, 900, 1, 1 << 20, 2])
    assert [x.tolist() for x in alignment.unpacked_pairs(alignment.packed_pairs(at, times))] == [at.tolist(), times.tolist()]
    assert [len(x) for x in alignment.unpacked_pairs(alignment.packed_pairs(at[:0], times[:0]))] == [0, 0]


def one_apart(words):
    """Near words of every word, by deleting each letter and by equal rests around one letter."""
    near, rests = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            if (short := w[:i] + w[i + 1 :]) in words:
                near[w].add(short)
                near[short].add(w)
            rests[w[:i], w[i + 1 :]].add(w)
    for group in rests.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain_variants(docs):
    import re

    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = one_apart(counts)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts)


def rows_of(frame):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def test_variants_match_plain(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows_of(spelling.op12_spelling_variants(spark, sf_dir)) == plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    got = rows_of(spelling.variants(odd))
    assert got == plain_variants([(r.doc_id, r.text) for r in odd.collect()]) and got
    assert spelling.variants(none).count() == 0


def test_variants_of_few_letters(spark):
    """Words over two letters: repeated bigrams, ties in every rank, long chains of forms."""
    draw = random.Random(5)
    words = {"".join(draw.choice("abÉ"[: draw.choice([2, 3])]) for _ in range(draw.choice([5, 5, 6, 7, 9]))) for _ in range(250)}
    docs = [(k, " ".join([w] * draw.choice([3, 4, 6, 12, 24, 50]))) for k, w in enumerate(sorted(words))]
    docs += [(None, "Aaaaaa aaaaaa AAAAAA"), (7, "x" * 3000 + " " + "x" * 2999 + " ÀÀÀÀÀ×÷ " * 3), (8, ("y" * 40 + " ") * 5 + ("y" * 41 + " ") * 11)]
    got = rows_of(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == plain_variants(docs) and sum(r[4] for r in got) > 500 and any(r[1] and r[2] != r[1] for r in got)


def test_one_edit_changes_at_most_two_letters(spark):
    """Words that share their rare first bigram and length, so that all meet: pairs are those of brute force, and parities allow them."""
    draw = random.Random(4)
    words = {"qz" + "".join(draw.choice("abÿ") for _ in range(draw.randrange(4, 6))) for _ in range(150)}
    near = {(a, b) for a in words for b in words if one_edit(a, b)}
    assert near and all((spelling.letters(a) ^ spelling.letters(b)).bit_count() <= 2 for a, b in near)
    got = spelling.near_pairs(spark.createDataFrame([(w,) for w in sorted(words)], "word string")).collect()
    assert {(r.a, r.b) for r in got} == near and len(got) == len(near)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_exploded_words_are_not_broadcast(spark):
    """Spark sizes the places of the words by the words, so it would send all of them to every executor."""
    words = spark.createDataFrame([(f"word{i:04d}", 9) for i in range(3000)], "word string, n long")
    plan = spelling.near_pairs(words)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_pivots_are_the_cheapest_disjoint_two():
    draw = random.Random(1)
    for _ in range(300):
        grams = [(at, draw.randrange(9)) for at in draw.sample(range(12), draw.randrange(3, 9))]
        got = spelling.pivots(grams)
        pairs = [(x, y) for x in grams for y in grams if x[0] + 2 <= y[0]]
        assert got[0][0] + 2 <= got[1][0] and sum(f for _, f in got) == min(x[1] + y[1] for x, y in pairs)


def plain_phrases(text, sample):
    """Longest matches by search in the sample; a letter that is not in it is a phrase."""
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) + 1 and text[at : at + size] in sample:
            size += 1
        at += max(1, size - 1)
        n += 1
    return n


def test_phrases_match_plain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(docs)
    table = language.letter_table(model.letters)
    samples = {lang: bytes(language.codes_of(text, table)) for lang, text in language.sample(docs)}
    assert model.languages == tuple(sorted(samples)) and model.sizes == tuple(len(samples[x]) for x in model.languages)
    texts = [r.text for r in docs.filter("n_chars < 900").orderBy("doc_id").limit(12).collect()] + ["", "ß", "日本 語", "a  B\n1c " * 90, "ñ" * 40, "é"]
    codes = [language.codes_of(t, table)[: language.PIECE] for t in texts]
    got = language.phrases([c for c in codes if len(c)], model)
    want = [[plain_phrases(bytes(c), samples[x]) for x in model.languages] for c in codes if len(c)]
    assert got.tolist() == want


def test_language_verdicts(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(docs)
    table = language.letter_table(model.letters)
    samples = {lang: bytes(language.codes_of(text, table)) for lang, text in language.sample(docs)}
    odd = odd.filter("text IS NULL OR n_chars < 4000")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = {}
    for r in language.identify(odd, model).collect():
        got.setdefault(r.doc_id, r)
    for doc_id, text in rows:
        r = got[doc_id]
        assert r.held_out == (zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 3 == 1)
        codes = bytes(language.codes_of(text or "", table))
        cost = {
            x: sum(plain_phrases(codes[at : at + language.PIECE], samples[x]) for at in range(0, len(codes), language.PIECE)) * np.log2(len(samples[x]) + 1)
            for x in model.languages
        }
        if not any(codes):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            best, second = sorted(cost.values())[:2]
            assert cost[r.lang_pred] == best and r.score == pytest.approx(second / (best + second))
    assert language.identify(none, model).count() == 0
    assert language.fit(none) == language.Model()
    assert {(r.lang_pred, r.score) for r in language.identify(odd, language.Model()).collect()} == {("und", 0.0)}


def test_language_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    found = language.op13_language_id(spark, sf_dir.replace("sf0.001", "sf0.01"))
    held = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.99 and all(0 <= r.score <= 1 for r in held)


def test_language_samples_leave_the_held_out_third(spark):
    rows = [(i, f"unique{i} " + "abc " * 5, "xx") for i in range(60)]
    found = " ".join(t for _, t in language.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    for i, _, _ in rows:
        assert (f"unique{i} " in found) == (zlib.crc32(str(i).encode()) % 3 != 1)
