"""Text operators against brute force: the smallest table and edge rows."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import Row

from priorframe.llm import byte_bpe, hashing, katz, line_crf, records, setjoin, suffix_index, toxicity
from priorframe.llm.common import documents, table

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, block int, h string, n int, key bigint"


def words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def edges(spark):
    base = " ".join(f"tok{i % 97}x{i}" for i in range(300))
    near = base.replace("tok5x5 ", "other ")
    long = "pass " + "ab cd ef gh " * 9000 + base
    texts = [
        (7, None), (3, ""), (4, " \t\n\x0b"), (5, "one two"), (6, "ONE  two"), (8, base), (9, base), (9, base), (10, near), (11, long),
        (12, "é" * 80 + "x" + "é" * 60), (13, "q" + "é" * 70), (None, base.upper()), (None, "lonely words of a row without an id"),
        (14, "aaaa" * 400), (15, "b" + "aaaa" * 100), (16, base[:400] + " and then " + base[700:1200]), (17, "日本語 テキスト 🙂" * 20),
    ]
    return spark.createDataFrame([Row(doc_id=i, text=t, lang="x", block=1, h="h", n=2, key=3) for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module", params=["table", "edges"])
def docs(request, spark, sf, edges):
    return documents(spark, sf) if request.param == "table" else edges


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def same(got, want):
    key = lambda t: tuple((v is None, str(v)) for v in t)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# --- near duplicates

def brute_groups(rows, size=5, percent=80):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            lists[g].append(i)
    for i, j in {(a, b) for m in lists.values() for a in m for b in m if a < b}:
        common = len(sets[i] & sets[j])
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = d if least[r] is None else min(d, least[r])
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def test_near_duplicates(docs):
    same(setjoin.near_duplicates(docs).collect(), brute_groups(pairs(docs)))


def test_near_duplicates_in_a_large_group(spark, monkeypatch):
    """Hundreds of near copies, chains across the threshold, several blocks and buckets."""
    monkeypatch.setattr(setjoin, "BLOCK_BYTES", 40_000)
    monkeypatch.setattr(setjoin, "BUCKET_KEYS", 2_000)
    monkeypatch.setattr(setjoin, "PIECE", 20)
    monkeypatch.setattr(setjoin, "STRIP", 100)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    shared = " ".join(f"passage{i}" for i in range(60))
    rows = []
    for i in range(240):
        body = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 4)):
            body[k] = f"edit{rng.integers(0, 40)}"
        rows.append((i, " ".join(body)))
    rows += [(1000 + i, shared + " " + " ".join(f"own{i}x{k}" for k in range(20 + i % 60))) for i in range(80)]
    rows += [(2000 + i, " ".join(f"chain{k}" for k in range(5 * i, 5 * i + 100))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    same(setjoin.near_duplicates(df).collect(), brute_groups(rows))


# --- repeated text

def brute_repeats(rows, length=50):
    first = {}
    order = [math.inf if d is None else d for d, _ in rows]
    bodies = [(t or "").encode() for _, t in rows]
    for o, b in zip(order, bodies, strict=True):
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(o, first.get(w, math.inf))
    out = []
    for (d, _), o, b in zip(rows, order, bodies, strict=True):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < o:
                gone[i : i + length] = True
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_text(docs, monkeypatch):
    check_repeats(docs, 8, monkeypatch)


def test_repeated_text_filed_by_window(edges, monkeypatch):
    check_repeats(edges, 0, monkeypatch)


def test_repeated_text_filed_by_context(docs, monkeypatch):
    monkeypatch.setattr(suffix_index, "HOT", 1)
    check_repeats(docs, 8, monkeypatch)


def test_segments_need_a_shared_context():
    """Texts that have short substrings in common, but no window of full length, send nothing."""
    rng = np.random.default_rng(12)
    phrases = ["".join(chr(97 + k) for k in rng.integers(0, 26, 24)) for _ in range(40)]
    fill = lambda n: "".join(chr(97 + k) for k in rng.integers(0, 26, n))
    bodies = [b"".join((p + fill(12)).encode() for p in rng.permutation(phrases)) for _ in range(20)]
    periodic = [b"-" * 300, b"x" * 9 + b"-" * 200, b"ab" * 90 + b"-" * 70, fill(30).encode() + b"ab" * 60]
    w = suffix_index.Windows([*bodies, *periodic])
    keys, text = w.short(48), w.text
    pairs = np.unique(np.stack([keys, text.astype(np.uint64)], 1), axis=0)
    found, count = np.unique(pairs[:, 0], return_counts=True)
    found = found[count > 1]
    start, end, text, _, _ = w.spans(found, np.ones(len(found), np.uint8), 48, 8)
    anchors = np.unique(np.stack([w.key, w.text.astype(np.uint64)], 1), axis=0)[:, 0]
    assert np.unique(anchors, return_counts=True)[1].max() > 1 and not (text < len(bodies)).any()
    # Every window that two texts have lies in a segment.
    starts = set(suffix_index.ragged(start, end - start).tolist())
    seen = {}
    for t, (a, b) in enumerate(zip(w.first, w.first[1:], strict=False)):
        for i in range(a, b - 49):
            seen.setdefault(w.data[i : i + 50].tobytes(), []).append((t, i))
    repeated = {i for places in seen.values() if len({t for t, _ in places}) > 1 for _, i in places}
    assert len(repeated) > 300 and repeated <= starts


def check_repeats(docs, common, monkeypatch):
    monkeypatch.setattr(suffix_index, "COMMON_TIER", common)
    monkeypatch.setattr(suffix_index, "COMMON_MOST", common)
    monkeypatch.setattr(suffix_index, "BATCH", 40)
    monkeypatch.setattr(setjoin, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(suffix_index, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(suffix_index, "BUCKET_BYTES", 90_000)
    same(suffix_index.repeated_text(docs).collect(), brute_repeats(pairs(docs)))


def test_levels_grow_geometrically():
    rng = np.random.default_rng(0)
    family, seen = suffix_index.SuffixLevels(), {}
    for batch in range(40):
        w = np.array([f"{v:050d}".encode() for v in rng.integers(0, 600, 30)], "S50")
        got = family.add(w, np.full(30, batch))
        for v, g in zip(w.tolist(), got.tolist(), strict=True):
            assert g == min(seen.get(v, batch), batch)
        for v in w.tolist():
            seen.setdefault(v, batch)
    sizes = [len(level.windows) for level in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False)) and len(sizes) <= 10


# --- language model

def brute_katz(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows]
    texts = [[*words(t), None] for _, t in rows]
    train = [t for t, h in zip(texts, held, strict=True) if not h]
    one, two = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["<"] + t[:-1], t, strict=True))
    n = sum(one.values())
    hist = lambda c: [sum(v == r for v in c.values()) for r in range(1, 7)]
    d1, d2 = katz.discounts(hist(one)), katz.discounts(hist(two))
    cut = lambda d, c: d[c] * c if c <= 5 else c
    uni = {w: cut(d1, c) / n for w, c in one.items()}
    rest = 1 - math.fsum(uni.values())
    if rest <= 1e-9:
        uni, rest = {w: p * n / (n + 1) for w, p in uni.items()}, 1 / (n + 1)
    after = defaultdict(dict)
    for (u, w), c in two.items():
        after[u][w] = c
    model = {}
    for u, s in after.items():
        total, mass = sum(s.values()), math.fsum(cut(d2, c) for c in s.values())
        total, left = (total, 1 - mass / total) if 1 - mass / total > 1e-12 else (total + 1, 1 - mass / (total + 1))
        model[u] = ({w: cut(d2, c) / total for w, c in s.items()}, left / (1 - math.fsum(uni[w] for w in s)))
        assert math.fsum(model[u][0].values()) + model[u][1] * (math.fsum(p for w, p in uni.items() if w not in s) + rest) == pytest.approx(1)

    def p(u, w):
        seen, weight = model.get(u, ({}, 1.0))
        return seen[w] if w in seen else weight * uni.get(w, rest)

    for (d, _), t, h in zip(rows, texts, held, strict=True):
        base = math.fsum(math.log10((one[w] + 0.1) / (n + 0.1 * (len(one) + 1))) for w in t)
        score = math.fsum(math.log10(p(u, w)) for u, w in zip(["<"] + t[:-1], t, strict=True))
        yield d, h, len(t), sum(one[w] > 0 for w in t), n, base, score


def test_katz(docs, monkeypatch):
    check_katz(docs, katz.PIECE_TOKENS, monkeypatch)


def test_katz_with_contexts_in_pieces(edges, monkeypatch):
    check_katz(edges, 50, monkeypatch)


def check_katz(docs, piece, monkeypatch):
    monkeypatch.setattr(katz, "PIECE_TOKENS", piece)
    monkeypatch.setattr(setjoin, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(setjoin, "BUCKET_KEYS", 20_000)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got, want = sorted(map(tuple, katz.score(docs).collect()), key=key), sorted(brute_katz(pairs(docs)), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


# --- tokens

def test_byte_bpe(docs):
    import tiktoken

    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(BPE), special_tokens={})
    want = []
    for d, t in pairs(docs):
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    same(byte_bpe.round_trip(docs, BPE, public_tokenizers.PATTERN).collect(), want)


def test_transducer_forgets_and_decoder_waits():
    import tiktoken

    ranks = byte_bpe.read_ranks(BPE)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    small = byte_bpe.Transducer(ranks, states=20)
    for word in ["thonanthe", "über", "ß" * 30, "日本語" * 5, "a" * 200, "zzqqxxjj", "🙂🙂"] * 3:
        ids = small.encode(word.encode())
        assert ids == library.encode_ordinary(word)
        decoder = byte_bpe.StreamingDecoder(small.bytes_of)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == word


def test_records(spark, docs):
    from tokenizers import Tokenizer

    library, at, want = Tokenizer.from_file(WORDS), 0, []
    rows = pairs(docs)
    got = records.token_records(docs, WORDS, roll_bytes=20_000).collect()
    by_id = defaultdict(list)
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        by_id[d].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    for r in got:
        assert r.start == at
        at += r.n_tokens
        by_id[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(by_id.values())


class Counted:
    """A tokenizer that counts the texts it gets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode(self, text, **options):
        self.texts += 1
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_of_letters_go_straight_to_the_model():
    known = records.WordEncoder(WORDS, "<u2")
    library, known.tokenizer = known.tokenizer, Counted(known.tokenizer)
    texts = [f"Wor{chr(97 + i % 26)}d{chr(97 + i // 26)}x of Straße{chr(97 + i % 26)}, год{chr(1072 + i % 32)} 東京 the. end" for i in range(300)]
    got = list(known.encode(pa.array(texts)))
    assert got == [np.array(library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert known.tokenizer.texts <= 2  # the marks alone


@pytest.mark.parametrize("cached", [1, 40, 1_000_000])
def test_word_encoder_gives_the_ids_of_whole_texts(cached):
    odd = [
        None, "", " ", "  a  b\n\n", "İstanbul İ. ΣΑΣ ὈΔΥΣΣΕΎΣ", "H\u0331 h\u0331 e\u0301a e\u0301. ẖ K Å ﬁ ǅ ß", "한국어 \u1112\u1161\u11ab क़ \u0915\u093c ไทย",
        "it's IT'S don't'll 's '", "a1b22 x² Ⅷ ٣٤ 12.5,", "<|startoftext|>a <|ENDOFTEXT|> <|endoftext|>.", "a\u00a0b \u2003 c\u0085d e\u2028f g\x1ch i\0j \0",
        "the... THE,, The!? über. Über.. é. ...", "🙂🙂 a🙂b \U00020000字 ʰa ªº", "\u0301 \u0308a a\u200db \ufeff", "word\tword\x0bword\x0cword\rword",
    ]
    draw = np.random.default_rng(3)
    letters = list("aAbZé'sİß.,!$#1٣\u0301\u0308ǅк한中 \n\u00a0|<>")
    odd += ["".join(draw.choice(letters, 40)) for _ in range(300)]
    known = records.WordEncoder(WORDS, "<u2", cached=cached)
    library = known.tokenizer
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes() for t in odd]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(odd))), pa.array(odd, pa.string())], ["doc_id", "text"])
    for most in (1, 500, 1 << 20):
        parts = list(records.slices(batch, most))
        assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
        assert most > 1 or max(p.num_rows for p in parts if p.column(1).null_count == 0) <= 2
        assert [ids for p in parts for ids in known.encode(p.column(1))] == want


def test_a_damaged_record_is_refused(tmp_path):
    w = records.RecordWriter(str(tmp_path), "f", 2)
    w.add(5, np.array([1, 2, 3], "<u2").tobytes())
    w.add(None, b"")
    w.close()
    reader = records.RecordReader(f"{tmp_path}/f")
    (a, _), (b, before) = reader.index(0, 2).tolist()
    assert reader.record(b)[0] is None and before == 3
    assert reader.record(a)[1].tolist() == [1, 2, 3]
    data = bytearray((tmp_path / "f.rec").read_bytes())
    data[a + 20] ^= 1
    (tmp_path / "f.rec").write_bytes(data)
    with pytest.raises(ValueError, match="damaged"):
        records.RecordReader(f"{tmp_path}/f").record(a)


# --- quality

def brute_rules(text):
    text = text or ""
    w = text.encode().split()
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, sf, docs):
    labels = table(spark, sf, "labels")
    rows = dict_of = defaultdict(list)
    for d, t in pairs(docs):
        rows[d].append(brute_rules(t))
    for r in line_crf.quality(docs, labels).collect():
        figures = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        dict_of[r.doc_id].remove(figures)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert not any(rows.values())


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(1)
    for _ in range(30):
        weights, moves = rng.normal(size=len(line_crf.FEATURES)), rng.normal(size=(2, 2))
        bits = [int(b) for b in rng.integers(0, 1 << len(line_crf.FEATURES), 7)]
        decoder = line_crf.Decoder(weights.tolist(), moves.tolist())
        score = lambda lab: sum(decoder.score(b) * y for b, y in zip(bits, lab, strict=True)) + sum(moves[a, b] for a, b in zip(lab, lab[1:], strict=False))
        best = max((tuple(i >> k & 1 for k in range(7)) for i in range(128)), key=score)
        assert score([int(x) for x in decoder.labels(bits)]) == pytest.approx(score(best))


def test_quality_accuracy(spark, sf):
    found = {r.doc_id: r for r in line_crf.quality(documents(spark, sf), table(spark, sf, "labels")).collect()}
    marked = [(r.quality, found[r.doc_id]) for r in table(spark, sf, "labels").collect()]
    clean = [f.kept for q, f in marked if q == 1 and not f.base_failed]
    junk = [f.kept for q, f in marked if q == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.1 * len(junk)
    nothing = table(spark, sf, "labels").limit(0)
    assert all(r.kept == (not r.base_failed) for r in line_crf.quality(documents(spark, sf), nothing).collect())


# --- toxicity

def test_toxicity(spark, edges):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    out = {r.doc_id: r for r in toxicity.score(documents(spark, sf), labels, locate=True).collect()}
    held = [(r.toxic, out[r.doc_id]) for r in labels.collect() if out[r.doc_id].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.values())
    pos, neg = [r.score for y, r in held if y == 1], [r.score for y, r in held if y == 0]
    assert np.mean([[(a > b) + (a == b) / 2 for b in neg] for a in pos]) > 0.7
    assert np.mean([s >= 0.7 for s in neg]) < 0.05
    assert any(r.offending for y, r in held if y == 1 and r.predicted)
    some = toxicity.score(edges, labels.limit(0)).collect()
    assert len(some) == edges.count() and {r.predicted for r in some if not r.n_sentences} == {0}


# --- shared pieces

def test_empty_tables(spark, sf, edges):
    none, labels = edges.limit(0), table(spark, sf, "labels")
    for out in (
        setjoin.near_duplicates(none), suffix_index.repeated_text(none), katz.score(none), records.token_records(none, WORDS),
        byte_bpe.round_trip(none, BPE, public_tokenizers.PATTERN), line_crf.quality(none, labels), toxicity.score(none, labels),
    ):
        assert out.collect() == []


def test_packing():
    rng = np.random.default_rng(2)
    for values in ([], [0], [7, 7, 1 << 63], rng.integers(0, 1 << 42, 5000)):
        x = np.sort(np.array(values, np.uint64))
        assert (hashing.unpack_sorted(hashing.pack_sorted(x)) == x).all()
        assert (katz.from_planes(katz.planes(x)) == x).all()
