"""Tokenizer alignment against plain Python, and the perfect hash on its own."""

import hashlib
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerleaf.llm.alignment import A_FILE, A_RANKS, B_FILE, PART_BYTES, Alignment, Tokenizers, _in_parts, op11_alignment, parts_of
from ledgerleaf.llm.perfect import PerfectHash

SCHEMA = "doc_id long, text string, slice long, shard int, keys string, counts string"


def rows():
    rng = np.random.default_rng(8)
    letters = [*"abcdefgh  \n\t.,'0123", "é", "ß", "日本", "́", "😀", "the ", "ing ", "ption"]
    texts = ["".join(rng.choice(letters, int(n))) for n in rng.integers(1, 300, 60)]
    texts += [None, "", " ", "  \n", "x", "it's 2026", "▁odd", "a\x00b", "<|endoftext|> <s></s> <unk>", "<0x41>", "ﬁ Å é", "same text here", "same text here", " the quick brown"]
    return [*enumerate(texts), (None, "no id"), (3, "repeated id"), (3, "repeated id"), (900, "long words " * 60000), (901, "y" * 200000), (902, " " * 100000)]


def brute(docs):
    a_file, b_file = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a_file.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    parsed = []
    for doc_id, text in docs:
        text = text or ""
        a = a_file.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_file.encode(text) if text else []
        a_bytes = [bytes(letter[c] for c in a_file.id_to_token(i)) for i in a]
        pieces = [b_file.id_to_piece(i) for i in b]
        b_bytes = [bytes.fromhex(p[3:5]) if b_file.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            a, b, a_bytes, b_bytes = [], [], [], []
        spans = []
        for ids, parts in ((a, a_bytes), (b, b_bytes)):
            at, own = 0, []
            for i, p in zip(ids, parts):
                own.append((at, at + len(p), i))
                at += len(p)
            spans.append(own)
        links, j = [], 0
        for start, end, x in spans[0]:
            while j < len(spans[1]) and spans[1][j][1] <= start:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < end:
                links.append((x, spans[1][k][2]))
                k += 1
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        inside = [defaultdict(list), defaultdict(list)]
        for side in (0, 1):
            g = 0
            for _, e, i in spans[side]:
                while cuts[g] < e:
                    g += 1
                inside[side][g].append(str(i))
        groups = ";".join(",".join(inside[0][g]) + "|" + ",".join(inside[1][g]) for g in range(len(cuts)))
        parsed.append((-1 if doc_id is None else doc_id, len(a), len(b), len(cuts), links, groups))
    counts = Counter(pair for *_, links, _ in parsed for pair in set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = [
        (d, na, nb, ng, len(ls), sum(counts[p] == best[p[0]] for p in ls), sum(counts[p] for p in ls), hashlib.sha256(g.encode()).hexdigest() if na else "")
        for d, na, nb, ng, ls, g in parsed
    ]
    return out, counts, parsed


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 5, 6, "k", "c") for r in rows()], SCHEMA).repartition(3)


def test_documents(docs):
    want, _, parsed = brute(rows())
    assert sum(not w[1] for w in want) == 3
    assert Counter(tuple(r) for r in op11_alignment(docs).collect()) == Counter(want)


def test_small_slices_and_a_deep_tree(docs):
    want, counts, parsed = brute(rows())
    small = Alignment(docs, shards=3, fan_in=2, slice_bytes=2000)
    assert small.buckets >= 8
    got = small.documents().collect()
    assert Counter(tuple(r)[:-1] for r in got) == Counter(want)
    assert Counter(r["groups"] for r in got) == Counter(p[-1] for p in parsed)
    assert {(r["a"], r["b"]): r["n_docs"] for r in small.pair_counts().collect()} == counts


def test_without_ranks(spark):
    few = spark.createDataFrame([(i, t) for i, t in rows()[:20]], "doc_id long, text string")
    assert Counter(tuple(r)[:-1] for r in Alignment(few, a_ranks=None).documents().collect()) == Counter(brute(rows()[:20])[0])


def test_no_rows_and_no_tokens(spark):
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in op11_alignment(none).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert op11_alignment(none.limit(0)).count() == 0


def test_rank_file_gives_the_ids_of_the_tokenizer_file():
    both, rng = Tokenizers(A_FILE, A_RANKS, B_FILE), np.random.default_rng(2)
    for start in range(0, 0x30000, 0x400):
        some = [chr(c) for c in rng.integers(start, start + 0x400, 60) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}a 1{c}1 !{c}!  {c}\n" for c in some)
        assert both.a_own.encode_ordinary(text) == both.a_file.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint64)).astype(np.uint32)
    made = PerfectHash.loaded(*PerfectHash.build(rng.permutation(keys)).dumped())
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 32, 1000, dtype=np.uint64).astype(np.uint32), keys)
    assert (made.slots(others) == -1).all()


def test_parts_hold_each_document_once():
    sizes = np.array([0, 5, 0, 7, 100, 1, 1, 0, 9])
    parts = parts_of(sizes, 10)
    assert [k for i, j in parts for k in range(i, j)] == list(range(9))
    assert all(sizes[i : j - 1].sum() <= 10 for i, j in parts)
    assert parts_of(sizes[:0], 10) == [] and parts_of(np.zeros(3, int), 10) == [(0, 3)]


def test_memory_follows_the_part_and_not_the_slice():
    """Aligning 4 MB of text at once held over 100 MB; who reads ids alone has no encoder."""
    tokens = Tokenizers(A_FILE, A_RANKS, B_FILE)
    assert not {"a_own", "a_file"} & vars(tokens).keys()
    a, b = tokens.encoded(b"several words of a line, 2026\n" * 100)
    assert "a_file" not in vars(tokens)
    times = 8 * PART_BYTES // 3000
    a, b, n_a, n_b = np.tile(a, times), np.tile(b, times), np.full(times, len(a)), np.full(times, len(b))
    tracemalloc.start()
    n_links = [int(p.n_links.sum()) for p in _in_parts(a, b, n_a, n_b, tokens) if p.link_keys(32000) is not None]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(n_links) == 8 and peak < 50e6
