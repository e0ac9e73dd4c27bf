"""The operators on documents against brute force, on rows that hold every odd case."""

import hashlib
import itertools
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import fingerprint, lines, mixing, neardup, packing, passages, sharding
from ledgerleaf.llm.tools import words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, shard string, _bucket int, text_utf8 string, kept string"
VOCABULARY = "amber basil cedar delta ember fjord grove heron inlet jetty knoll larch mossy nylon ochre plume quartz river stone thorn umber vivid wharf xenon yield zebra".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"{VOCABULARY[a]}{VOCABULARY[b]}" for a, b in rng.integers(0, 26, (n, 2)))


def rows():
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    shared = prose(2, 70)
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, base.upper() + "\n\n"),
        (5, None), (6, ""), (7, "  \t\n "), (8, None),
        (9, "one two three"), (10, "One  two\nTHREE"), (11, "one two four"),
        (12, prose(3, 40) + "\n" + shared + "\n" + prose(4, 30)),
        (13, prose(5, 10) + "\n  " + shared.upper() + "\t\n" + prose(6, 10)),
        (14, "short\nshort\nA long enough line\na long enough LINE \nshort"),
        (15, "a long enough line\nélan vital über alles\n"),
        (16, "élan vital über alles\r\nother words here"),
        (17, "x" * 5000), (18, prose(7, 3000)), (19, "repeated row of words here"), (19, "repeated row of words here"),
        (20, prose(8, 60)), (20, prose(9, 60)), (None, "no id but words all the same"), (21, "日本語のテキスト 漢字 ABC"), (22, "end of text <|endoftext|> said"),
    ]
    sources = itertools.cycle(["web", "books", None, "web", "", "code"])
    return [(i, t, "en", s, None, 7, "x", 3, "y", "z") for (i, t), s in zip(texts, sources)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain():
    return [(-1 if r[0] is None else r[0], r[1], r[3]) for r in rows()]


def clusters(nodes, links):
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_lines(docs, empty):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    owners = defaultdict(set)
    for i, t, _ in plain():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                owners[key(line)].add(i)
    want = Counter()
    for i, t, _ in plain():
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if not (len(owners[key(x)]) > 1 and min(owners[key(x)]) != i)]
        want[(i, len(all_), len(all_) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in lines.op9_line_dedup(docs).collect()) == want
    assert lines.op9_line_dedup(empty).count() == 0
    out = lines.deduplicated_documents(docs)
    assert out.columns == docs.columns and out.count() == len(rows())


def test_lines_of_a_hot_key_over_many_ranges(spark):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the same line everywhere\nown "), "id", F.lit(" line")).alias("text"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    found = {r.doc_id: r.n_dropped for r in lines.op9_line_dedup(hot).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == {i: int(i > 0) for i in range(3000)}


def test_near_duplicates(docs, empty):
    sets = defaultdict(list)
    for i, t, _ in plain():
        w = words((t or "").encode())
        sets[i].append(set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else ({tuple(w)} if w else set()))
    links = [
        (i, j) for i, j in itertools.combinations(sets, 2)
        if any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[i] for b in sets[j])
    ]
    label = clusters(list(sets), links)
    want = Counter((i, len(s), label[i], i == label[i]) for i, all_ in sets.items() for s in all_)
    assert Counter(tuple(r) for r in neardup.op8_near_duplicates(docs).collect()) == want
    assert neardup.op8_near_duplicates(empty).count() == 0
    out = neardup.distinct_documents(docs)
    assert out.columns == docs.columns
    assert Counter(-1 if r.doc_id is None else r.doc_id for r in out.collect()) == Counter(set(label.values()))


def test_near_duplicates_that_miss_their_buckets_first(spark):
    """A chain of drifting copies: each is like its neighbours, the ends are not."""
    text, drift = prose(20, 300).split(), []
    for i in range(40):
        for k in range(6):
            text[(i * 37 + k * 50) % 300] = f"w{i}x{k}"
        drift.append((i, " ".join(text)))
    found = neardup.op8_near_duplicates(spark.createDataFrame(drift, "doc_id long, text string")).collect()
    sets = {i: set(zip(*(t.split()[k:] for k in range(5)))) for i, t in drift}
    links = [(i, j) for i, j in itertools.combinations(sets, 2) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    label = clusters(list(sets), links)
    assert {r.doc_id: r.component_id for r in found} == label


def test_near_duplicates_around_the_threshold(spark):
    """Copies so far apart that many pairs miss the threshold closely."""
    rng = np.random.default_rng(6)
    base, rows_ = prose(21, 300).split(), []
    for i in range(60):
        text = list(base)
        for k in rng.choice(300, 6, replace=False):
            text[k] = f"v{i}x{k}"
        rows_.append((i, " ".join(text)))
    sets = {i: set(zip(*(t.split()[k:] for k in range(5)))) for i, t in rows_}
    links = [(i, j) for i, j in itertools.combinations(sets, 2) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert 0 < len(links) < 800
    found = neardup.op8_near_duplicates(spark.createDataFrame(rows_, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == clusters(list(sets), links)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    common, own = rng.integers(0, 1 << 62, 600, dtype=np.uint64), rng.integers(0, 1 << 62, (2, 100), dtype=np.uint64)
    sets = [np.concatenate([common, own[0]]), np.concatenate([common, own[1]]), common[:1]]
    owner = np.repeat([0, 1, 2], [len(s) for s in sets])
    sketch = neardup.similarity_sketch(np.concatenate(sets), owner, 3, 512)
    assert (sketch != neardup.EMPTY).all()
    assert abs((sketch[0] == sketch[1]).mean() - 600 / 800) < 0.1


def test_shards(docs, empty):
    found = sharding.op5_shard_documents(docs).collect()
    assert len(found) == len(rows())
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in plain())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in found if r.doc_id in (1, 2)}) == 1 and len({r.shard for r in found if r.doc_id in (5, 8)}) == 1
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    assert sharding.op5_shard_documents(empty).count() == 0


def test_differencing_is_tight():
    rng = np.random.default_rng(2)
    sizes = np.zeros((2000, 24), np.int64)
    sizes[:, 0] = rng.integers(8, 5000, 2000)
    bins = np.bincount(sharding.differencing(sizes, 24)[:, 0], sizes[:, 0], minlength=24)
    assert bins.sum() == sizes.sum() and bins.max() - bins.min() <= 2
    few = np.zeros((3, 24), np.int64)
    few[:, 0] = [5, 5, 1]
    assert len(set(sharding.differencing(few, 24)[:, 0])) == 3


def waterfill(sizes, weights, total, repeats):
    target, open_ = {}, set(sizes)
    while True:
        rest = total - sum(target.values())
        share = sum(weights[s] for s in open_)
        over = {s for s in open_ if rest * weights[s] / share > repeats * sizes[s]} if open_ else set()
        if not over:
            return target | {s: rest * weights[s] / share for s in open_}
        target |= {s: float(repeats * sizes[s]) for s in over}
        open_ -= over


def test_mix(docs, empty):
    count = lambda t: len((t or "").encode().split())
    sizes = defaultdict(int)
    for _, t, s in plain():
        sizes[s] += count(t)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want = waterfill(sizes, weights, 1.5 * sum(sizes.values()), 2)
    found = mixing.op7_mix_sources(docs).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.op7_mix_sources(docs).collect()))
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((i, count(t)) for i, t, _ in plain())
    assert all(0 <= r.taken <= 2 * r["size"] for r in found)
    targets = Counter(round(r.target, 6) for r in found)
    assert set(targets) == {round(t, 6) for t in want.values()}
    taken = defaultdict(int)
    for r in found:
        taken[round(r.target, 6)] += r.taken
    for t in targets:
        same = [s for s in want if round(want[s], 6) == t]
        assert abs(taken[t] - t * len(same)) <= len(same)
    assert mixing.op7_mix_sources(empty).count() == 0
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(count(r.text) for r in out.collect()) == sum(r.taken for r in found)


def test_schedule_is_even(spark):
    targets = spark.createDataFrame([(0, 6000.0), (1, 3000.0), (2, 1000.0)], "rank long, target double")
    placed = sorted((r.place, r.rank) for r in mixing.schedule(targets, 10).collect())
    assert len(placed) == 1000 and len({p for p, _ in placed}) == 1000
    for n in (100, 300, 700):
        seen = Counter(r for _, r in placed[:n])
        assert all(abs(seen[k] - n * s) <= 6 for k, s in ((0, 0.6), (1, 0.3), (2, 0.1)))


def test_pack(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    ids = {}
    for i, t, _ in plain():
        own = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        ids.setdefault(i, []).append(own)
        want.update((i, len(own), k) for k in range(len(own)))
    found = packing.op1_pack(docs).collect()
    assert Counter((r.doc_id, r.doc_tokens, k) for r in found for k in range(r.start, r.start + r.length)) == want
    for r in found:
        assert r.ids_crc32 in {zlib.crc32(x[r.start : r.start + r.length].tobytes()) for x in ids[r.doc_id] if len(x) == r.doc_tokens}
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048 and end & (end - 1) == 0
    assert packing.op1_pack(empty).count() == 0


def test_ids_are_the_tokenizers():
    """Letters, marks, signs, blanks and special strings in any mix, and every letter alone."""
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(packing.tokenizer_path()), packing.WordEncoder(packing.tokenizer_path())
    assert encoder.by_words
    every = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    marks = [c for c in every if unicodedata.category(chr(c))[0] == "M"]
    odd = [0x1100, 0x1161, 0x11A8, 0xAC00, 0x3A3, 0x130, 0xA0, 0x2028, 0x85, 11, 12, 28, 31]
    pools = [range(1, 128), range(128, 0x600), marks, every, odd, [*map(ord, "HJTWY\u030c\u0331")], [*map(ord, "<|endoftext|>'sS 12")]]
    rng = np.random.default_rng(6)
    texts = ["".join(chr(pools[i][rng.integers(len(pools[i]))]) for i in rng.integers(0, len(pools), rng.integers(1, 14))) for _ in range(10_000)]
    texts += [f"a{chr(c)}B {chr(c)}{chr(c)} x'S{chr(c)}' {chr(c)}" for c in every if c < 0x3000 or c % 7 == 0]
    texts += ["hello <|endoftext|> world", "<|startoftext|>x", "<|STARTOFTEXT|>", "", " ", "it's 'n''s'sx ('s 1'2", "y" * 5000, "\u00e9" * 5000, "word " * 400_000]
    ids, sizes = encoder.encode(pa.array([t.encode() for t in texts], pa.binary()))
    ends = np.cumsum(sizes)
    found = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [t for t, w, a, b in zip(texts, found, ends - sizes, ends) if w.ids != ids[a:b].tolist()] == []
    ids, sizes = encoder.encode(pa.array([b"", b" \n"], pa.binary()))
    assert len(ids) == 0 and sizes.tolist() == [0, 0]


def test_other_tokenizer_rules_take_the_whole_text(tmp_path):
    import json

    from tokenizers import Tokenizer

    rules = json.load(open(packing.tokenizer_path()))
    rules["normalizer"] = {"type": "Lowercase"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(rules))
    encoder = packing.WordEncoder(str(path))
    ids, _ = encoder.encode(pa.array(["A  b\u00a0c 12".encode()], pa.binary()))
    assert not encoder.by_words and ids.tolist() == Tokenizer.from_file(str(path)).encode("A  b\u00a0c 12", add_special_tokens=False).ids


def test_retrieval_prefers_like_texts():
    rng = np.random.default_rng(3)
    tails = [np.concatenate([rng.integers(k % 4 * 500, k % 4 * 500 + 500, 256)]).astype("<u4") for k in range(40)]
    df = np.zeros(2000)
    for t in tails:
        df[np.unique(t)] += 1
    idf = np.maximum(0, np.log((40 - df + 0.5) / (df + 0.5)))
    windows = list(packing.fill_windows(tails, idf, 256.0))
    assert sum(n for w in windows for _, _, n in w) == 40 * 256
    assert sum(len({r % 4 for r, _, _ in w}) == 1 for w in windows) >= len(windows) // 2


def test_passages(docs, empty):
    found = passages.op3_shared_passages(docs).collect()
    pairs = {(r.doc_id, r.other_id) for r in found}
    assert {frozenset(p) for p in pairs} >= {frozenset(p) for p in [(1, 2), (1, 3), (1, 4), (12, 13)]}
    assert not {i for p in pairs for i in p} - {1, 2, 3, 4, 12, 13}
    texts = {i: words((t or "").encode()) for i, t, _ in plain()}
    shared = next(r for r in found if {r.doc_id, r.other_id} == {12, 13})
    assert texts[shared.doc_id][shared.start : shared.end] == texts[shared.other_id][shared.other_start : shared.other_end] == words(prose(2, 70).encode())
    fuzzy = next(r for r in found if {r.doc_id, r.other_id} == {1, 3} or {r.doc_id, r.other_id} == {3, 4})
    assert (fuzzy.matched, fuzzy.end - fuzzy.start) == (119, 120)
    assert passages.op3_shared_passages(empty).count() == 0


def test_chain_is_the_best_one():
    """The tree against a quadratic search on matches that cross."""
    rng = np.random.default_rng(4)
    for _ in range(20):
        p, q = np.sort(rng.integers(0, 60, 14)), rng.integers(0, 60, 14)
        best = np.zeros(14)
        for i in range(14):
            before = [best[j] - passages.GAP_COST * (p[i] - p[j] + q[i] - q[j]) for j in range(i) if p[j] < p[i] and q[j] < q[i]]
            best[i] = passages.KMER + max([0, *before])
        assert abs(passages.best_chains(p, q)[0][0] - best.max()) < 1e-9


def test_fingerprints(docs, empty):
    parser = fingerprint.PhraseParser()
    unique = sorted({(i, t) for i, t, _ in plain() if i not in (19, 20)}, key=lambda x: -x[0])
    frame = docs.filter("doc_id IS NULL OR doc_id NOT IN (19, 20)")
    found = {r.doc_id: r for r in fingerprint.op10_fingerprints(frame).collect()}
    assert len(found) == len(unique)
    for k, (i, t) in enumerate(unique):
        a, b = t or "", unique[(k + 1) % len(unique)][1] or ""
        edited = a[: len(a) - len(a) // 3] + b[: len(a) // 3]
        own, other, following = (parser.signature(x) for x in (a, edited, b))
        assert found[i].n_chars == len(a) and found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i].fingerprint == fingerprint.as_string(own) and found[i].edited_fingerprint == fingerprint.as_string(other)
        assert found[i].near_edited == fingerprint.likeness(own, other) and found[i].near_next == fingerprint.likeness(own, following)
    assert found[1].fingerprint == found[2].fingerprint
    assert fingerprint.op10_fingerprints(docs).count() == len(rows())
    assert fingerprint.op10_fingerprints(empty).count() == 0


def test_phrases_are_those_of_a_plain_parse():
    text, known, phrase, plain_phrases = prose(5, 200), set(), "", []
    for c in text:
        phrase += c
        if phrase not in known:
            known.add(phrase)
            plain_phrases.append(phrase)
            phrase = ""
    lengths, open_ = fingerprint.PhraseParser.parse(text, set(), "")
    assert lengths == [len(p) for p in plain_phrases] and open_ == phrase
    assert "".join(plain_phrases) + open_ == text
