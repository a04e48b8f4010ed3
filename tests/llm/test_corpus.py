"""Fingerprints, token files, near-dedup, mixing, packing, transcripts and the pipeline."""

import hashlib
import itertools
import json
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tableloom.llm import chunks, flow, mixing, packing, queries, token_files, transcripts
from tableloom.llm import weighted_minhash as near
from tableloom.llm.components import components
from tableloom.llm.neighbours import map_with_next
from tableloom.session import scratch_path


def test_gear_hashes_equal_the_plain_sum():
    data = np.random.default_rng(5).integers(0, 256, 300).astype(np.uint8)
    for i, made in enumerate(chunks.gear_hashes(data).tolist()):
        reach = range(min(i + 1, chunks.REACH))
        assert made == sum(int(chunks.GEAR[data[i - k]]) << k for k in reach) % 2**32


def test_chunks_cover_the_text_and_survive_a_shift(monkeypatch):
    text = " ".join(str(i * i) for i in range(3000))
    data = text.encode()
    ends = chunks.chunk_ends(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= chunks.LONGEST
    whole, shifted = chunks.chunk_tokens(text), chunks.chunk_tokens("A few new words. " + text)
    assert chunks.containment(whole, shifted) > 0.98
    assert (chunks.parsed(chunks.rendered(whole)) == whole).all()
    monkeypatch.setattr(chunks, "SLICE", 1000)
    assert chunks.chunk_ends(data) == ends
    assert chunks.containment(chunks.chunk_tokens(""), chunks.chunk_tokens("")) == 1
    assert chunks.containment(chunks.chunk_tokens(""), whole) == 0


def test_next_rows_in_order(odd_documents, no_documents):
    made = map_with_next(odd_documents, lambda a, b: (a, b), ["a", "b"], "a string, b string")
    rows = made.collect()
    given = sorted(
        (r.doc_id if r.doc_id is not None else -(2**63), r.text or "") for r in odd_documents.collect()
    )
    wanted = [(x[1], y[1]) for x, y in zip(given, given[1:] + given[:1])]
    assert sorted((r.a, r.b) for r in rows) == sorted(wanted)
    assert map_with_next(no_documents, lambda a, b: (a, b), ["a", "b"], "a string, b string").count() == 0


def test_fingerprint_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    made = {r.doc_id: r for r in queries.fingerprints(spark, folder).collect()}
    assert len(made) == len(docs)
    for one, following in zip(docs, docs[1:] + docs[:1]):
        half = len(one.text) // 2
        edited = one.text[: len(one.text) - half] + following.text[:half]
        row = made[one.doc_id]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == chunks.rendered(chunks.chunk_tokens(one.text))


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
def test_bit_fields_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001)
    payload = token_files.pack(ids, bits)
    assert len(payload) == -(-1001 * bits // 8)
    assert (token_files.unpack(payload, bits, 0, 1001) == ids).all()
    assert (token_files.unpack(payload, bits, 333, 77) == ids[333:410]).all()


def test_token_files_round_trip(spark, odd_documents, no_documents):
    model = Tokenizer.from_file(queries.WORD_PIECES)
    files = scratch_path(spark, "tokens")
    token_files.write_tokens(odd_documents, queries.WORD_PIECES, 1, files)
    rows = token_files.read_tokens(spark, files).orderBy("start").collect()
    texts = defaultdict(list)
    for r in odd_documents.collect():
        texts[r.doc_id].append(r.text or "")
    ids = [r.doc_id if r.doc_id is not None else -1 for r in rows]
    assert ids == sorted(ids) and len(rows) == 10
    before = 0
    for r in rows:
        wanted = model.encode(texts[r.doc_id].pop(), add_special_tokens=False).ids + [1]
        assert (r.ids, r.start, r.n_tokens) == (wanted, before, len(wanted))
        before += len(wanted)
    sums = {r.start: r.ids_crc32 for r in token_files.read_checksums(spark, files).collect()}
    for r in rows:
        assert sums[r.start] == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    again = token_files.document_ids(spark.read.parquet(files), 7)
    assert again.tolist() == next(r.ids for r in rows if r.doc_id == 7)
    empty = scratch_path(spark, "tokens")
    token_files.write_tokens(no_documents, queries.WORD_PIECES, 1, empty)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_token_files_find_added_tokens(spark):
    model = Tokenizer.from_file(queries.WORD_PIECES)
    texts = [
        "the end<|endoftext|> next", "<|endoftext|>", "<|startoftext|>A<|endoftext|><|endoftext|>b",
        "THE <|ENDOFTEXT|> <|EndOfText|>x", "<|endoftext|", "é<|endoftext|>漢 «<|startoftext|>»",
        "it's<|endoftext|>'s 12<|startoftext|>34", "<|end oftext|> <<|endoftext|>>", "after them",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    files = scratch_path(spark, "tokens")
    token_files.write_tokens(rows, queries.WORD_PIECES, 1, files)
    before = 0
    for r in token_files.read_tokens(spark, files).orderBy("doc_id").collect():
        wanted = model.encode(texts[r.doc_id], add_special_tokens=False).ids + [1]
        assert (r.ids, r.start, r.n_tokens) == (wanted, before, len(wanted)), texts[r.doc_id]
        before += len(wanted)
    assert model.encode(texts[0], add_special_tokens=False).ids == [518, 806, 49407, 1131]


@pytest.mark.parametrize("name, by_words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_any_tokenizer_gives_the_ids_of_the_whole_text(name, by_words, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED_WORDS", 50)
    path = public_tokenizers.path(name)
    model, encoder = Tokenizer.from_file(path), token_files.Encoder(path, 1)
    assert encoder.by_words is by_words
    rnd = np.random.default_rng(3)
    parts = [" ", "\t", "\n", "\x0b", "\xa0", "\u2003", "a", "Don't", "ÀÉ", "e\u0301", "\u0301", "ΣΑΣ", "漢字", "12", "!?"]
    parts += ["don.", "Don,", "DON", "x.,", ".", ",x", "é.", "E."]
    parts += ["<|endoftext|>", "<|startoftext|>", "\x1c", "\u200b", "İ", "ß", "\U0001f600", "'s", "_"]
    texts = ["".join(rnd.choice(parts, rnd.integers(0, 30))) for _ in range(600)] + [None, ""]
    for begin in range(0, len(texts), 100):
        made = encoder.encode(pa.array(texts[begin : begin + 100]))
        for text, ids in zip(texts[begin:], made, strict=False):
            wanted = model.encode(text or "", add_special_tokens=False).ids + [1]
            assert np.frombuffer(ids, encoder.kind).tolist() == wanted, text


@pytest.mark.parametrize("forms", [["NFC", "Lowercase"], ["NFKC", "StripAccents"], ["Lowercase", "NFD"], []])
@pytest.mark.parametrize("added", [None, "e\u0301", "x"])
def test_plain_words_are_encoded_as_one_sequence(forms, added, tmp_path, monkeypatch):
    described = json.loads(Tokenizer.from_file(queries.WORD_PIECES).to_str())
    described["normalizer"] = {"type": "Sequence", "normalizers": [{"type": form} for form in forms]}
    path = str(tmp_path / "tokenizer.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(described, file)
    if added:
        wider = Tokenizer.from_file(path)
        wider.add_tokens([added])
        wider.save(path)
    model, encoder, single = Tokenizer.from_file(path), token_files.Encoder(path, 1), []
    assert encoder.by_words and (encoder.plain is None) == bool(added)
    alone = encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda words: single.extend(words) or alone(words))
    near = [chr(c) for c in range(33, 0x180)]
    texts = [f"{a}B{a} é{a}" for a in near] + ["ÀÉx the<|endoftext|>", "e\u0301 ²ªµ", "", None]
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        wanted = model.encode(text or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(ids, encoder.kind).tolist() == wanted, text
    if not added:
        last = "\xff" if "NFC" in forms or not forms else "~"
        assert all(any(not "!" <= c <= last or "~" < c < "\xa1" for c in word) for word in single if word)


def test_sequences_are_not_cut_or_filled(tmp_path):
    model = Tokenizer.from_file(queries.WORD_PIECES)
    model.enable_truncation(3)
    model.save(str(tmp_path / "cut.json"))
    assert token_files.Encoder(str(tmp_path / "cut.json"), 1).plain is None


def test_words_not_met_again_are_forgotten():
    known, made = token_files.Remembered(3, np.dtype("<u2")), []

    def make(words):
        made.extend(words)
        yield words, np.array([len(w) for w in words for _ in w], np.uint16), np.array([len(w) for w in words])

    for listed in (["a", "bb"], ["ccc", "", "bb"], ["bb", "dddd"], [], ["eeeee", "bb", "f"], ["a", "bb"]):
        picked = known.numbers(listed, make)
        flat, sizes = known.ids()
        lists = np.split(flat, np.cumsum(sizes)[:-1])
        assert [lists[i].tolist() for i in picked] == [[len(w)] * len(w) for w in listed]
    assert made == ["a", "bb", "ccc", "", "dddd", "eeeee", "f", "a"]


def test_only_proven_tokenizers_are_cut_at_white_space():
    described = json.loads(Tokenizer.from_file(queries.WORD_PIECES).to_str())
    assert token_files.splits_at_white_space(described)
    cut = described["pre_tokenizer"]["pretokenizers"][0]
    for pattern in (r"\s?\p{L}+", ".+", "[^a]+", "a| b", "(a b)+", r"\W+"):
        cut["pattern"] = {"Regex": pattern}
        assert not token_files.splits_at_white_space(described), pattern
    for pattern in (r"\p{L}+|[0-9]", "'s|[^\\s]+", r"\w+|[^\w\s]+"):
        cut["pattern"] = {"Regex": pattern}
        assert token_files.splits_at_white_space(described), pattern
    described["normalizer"] = {"type": "Prepend", "prepend": "x"}
    assert not token_files.splits_at_white_space(described)


def test_a_hot_key_is_split_and_random_access_reads_one_block(spark):
    rows = [(7, f"w{i} " * 40) for i in range(3000)] + [(i, "x y") for i in range(8, 3000)]
    files = scratch_path(spark, "tokens")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    token_files.write_tokens(docs, queries.WORD_PIECES, 1, files)
    blocks = spark.read.parquet(files)
    held = blocks.where("low = 7").groupBy("range").count().count()
    assert held > 2
    starts = token_files.read_checksums(spark, files).orderBy("start").collect()
    assert [r.doc_id for r in starts] == sorted(r[0] for r in rows)
    model = Tokenizer.from_file(queries.WORD_PIECES)
    assert token_files.document_ids(blocks, 2000).tolist() == model.encode("x y").ids + [1]
    near = blocks.where((F.col("low") <= 2000) & (F.col("high") >= 2000))
    assert near.count() == 1
    with pytest.raises(KeyError):
        token_files.document_ids(blocks, -1)


def plain_classes(docs, factors):
    shingles = near.shingles_of(pa.array([r.text for r in docs]))
    holders, root = defaultdict(list), list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for h in shingles.of(i)[0].tolist():
            holders[h].append(i)
    pairs = {p for found in holders.values() for p in itertools.combinations(found, 2)}
    for x, y in pairs:
        if near.similarity(shingles.of(x), shingles.of(y), factors) >= near.SIMILARITY:
            a, b = sorted((find(x), find(y)))
            root[b] = a
    return [docs[find(i)].doc_id for i in range(len(docs))]


def test_near_dedup_equals_all_pairs(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    docs = table.orderBy("doc_id").collect()
    counts, n = near.cell_counts(table)
    wanted = plain_classes(docs, near.idf_factors(counts, n))
    made = queries.near_dedup(spark, folder).orderBy("doc_id").collect()
    assert [r.class_id for r in made] == wanted


def edited_copies(seed, n):
    """Copies of one text with random edits: some close to it, some only to others, some to none."""
    rnd = np.random.default_rng(seed)
    base = [f"w{i}" for i in rnd.integers(0, 5000, 150)]
    texts = []
    for i in range(n):
        words = list(texts[rnd.integers(0, len(texts))].split()) if texts and i % 3 == 0 else list(base)
        for at in rnd.integers(0, len(words), rnd.integers(0, 14)):
            words[at] = f"e{rnd.integers(0, 10**6)}"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("held, stripe, rounds", [(256, 2048, 3), (5, 40, 0)])
def test_large_groups_equal_all_pairs_of_candidates(spark, monkeypatch, held, stripe, rounds):
    """Texts that share two bands are linked exactly as if all pairs were compared."""
    for name, value in (("HELD_TEXTS", held), ("STRIPE", stripe), ("STAR_ROUNDS", rounds)):
        monkeypatch.setattr(near, name, value)
    texts = edited_copies(1, 250) + edited_copies(2, 60) + ["", "one two"] + ["a b c d e f g"] * 300
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    counts, n = near.cell_counts(table)
    factors = near.idf_factors(counts, n)
    shingles = near.shingles_of(pa.array(texts))
    bands = near.band_hashes(shingles, factors)
    root, links, similar = list(range(len(texts))), 0, 0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = [i for i in range(len(texts)) if texts.index(texts[i]) == i]
    for i in range(len(texts)):
        root[i] = texts.index(texts[i])
    for x, y in itertools.combinations(distinct, 2):
        if len(shingles.of(x)[0]) and near.similarity(shingles.of(x), shingles.of(y), factors) >= 0.8:
            similar += 1
            if (bands[x] == bands[y]).sum() >= 2:
                links += 1
                a, b = sorted((find(x), find(y)))
                root[b] = a
    wanted = [find(i) for i in range(len(texts))]
    assert links >= 0.99 * similar and len({find(i) for i in distinct}) > 20
    made = near.class_rows(near.near_duplicates(table)).orderBy("doc_id").collect()
    assert [r.class_id for r in made] == wanted


def test_held_texts_are_compared_as_pairs():
    texts = edited_copies(3, 40) + ["", "a b", "a b", None]
    factors = np.random.default_rng(0).uniform(1, 1.2, 1 << near.CELL_BITS).astype(np.float32)
    shingles = near.shingles_of(pa.array(texts))
    keys = [str(i) for i in range(len(texts))]
    a, b = near.Held(keys, shingles, factors).linked(keys, shingles, factors, 0.8)
    wanted = {
        (x, y)
        for x, y in itertools.permutations(range(len(texts)), 2)
        if len(shingles.of(x)[0])
        and near.similarity(shingles.of(x), shingles.of(y), factors) >= 0.8
    }
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == wanted


def test_near_dedup_on_odd_rows(odd_documents, no_documents):
    found = near.near_duplicates(odd_documents)
    made = sorted(map(tuple, near.class_rows(found).collect()), key=str)
    assert len(made) == 10
    assert [row for row in made if row[0] == 3] == [(3, 1, 4), (3, 1, 4)]
    assert (4, 4, 2) in made and (5, 4, 2) in made and (None, None, 1) in made
    kept = near.one_of_each(odd_documents, found)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 6, 7, 8]
    assert near.class_rows(near.near_duplicates(no_documents)).count() == 0


def test_components_of_random_edges(spark):
    draw = np.random.default_rng(2)
    edges = [tuple(map(int, e)) for e in draw.integers(0, 60, (40, 2))] + [(i, i + 1) for i in range(100, 140)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    wanted = {x: find(x) for x in root if find(x) != x}
    made = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in made} == wanted and len(made) == len(wanted)


def test_flow_prefers_first_copies():
    made = flow.route([10, 10], [[0, 1], [1]], [15, 15], 2)
    assert made[0][0] == 15 and made[1][1] + made[0][1] == 15
    assert sum(made[1].values()) >= 10


def test_flow_is_of_least_cost():
    """As much as possible, with as few second copies as possible, on small random cases."""
    draw = np.random.default_rng(6)
    for _ in range(60):
        n, k = int(draw.integers(1, 4)), int(draw.integers(1, 4))
        sizes = draw.integers(0, 3, n).tolist()
        members = [sorted(draw.choice(k, draw.integers(1, min(k, 2) + 1), replace=False).tolist()) for _ in range(n)]
        quotas = draw.integers(0, 5, k).tolist()
        ways = [
            [w for w in itertools.product(range(2 * size + 1), repeat=len(held)) if sum(w) <= 2 * size]
            for size, held in zip(sizes, members)
        ]
        best = None
        for chosen in itertools.product(*ways):
            used = [0] * k
            for held, way in zip(members, chosen):
                for quota, amount in zip(held, way):
                    used[quota] += amount
            if all(u <= q for u, q in zip(used, quotas)):
                twice = sum(max(0, sum(way) - size) for way, size in zip(chosen, sizes))
                best = max(best or (-1, 0), (sum(used), -twice))
        made = [sum(flow.values()) for flow in flow.route(sizes, members, quotas, 2)]
        twice = sum(max(0, amount - size) for amount, size in zip(made, sizes))
        assert (sum(made), -twice) == best


def plain_shares(sizes, weights, total, most):
    given, free, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * unit > most * sizes[i]]
        for i in over or free:
            given[i] = float(most * sizes[i]) if over else weights[i] * unit
        left -= sum(given[i] for i in over)
        free = [i for i in free if over and i not in over]
    return given


def test_shares_stop_at_the_cap(spark):
    given = plain_shares([10, 100, 100], [3, 1, 2], 315, 2)
    assert given[0] == 20 and given[2] == pytest.approx(2 * given[1])
    draw = np.random.default_rng(7)
    sizes = (10 ** draw.uniform(0, 5, 60)).astype(int).tolist() + [0]
    names = [f"s{i:03}" for i in range(60)] + [None]
    rows = list(zip(names, sizes))
    rng = np.random.default_rng(1).permutation(len(rows)).tolist()
    sources = spark.createDataFrame([rows[i] for i in rng], "source string, source_size long")
    made = mixing.shared_out(mixing.numbered(sources.repartition(5)), [3, 1, 2], 1.9 * sum(sizes), 2)
    wanted = plain_shares(sizes, [[3, 1, 2][i % 3] for i in range(61)], 1.9 * sum(sizes), 2)
    held = {r.source: r.target for r in made.collect()}
    assert [held[name] for name in names] == pytest.approx(wanted)


def test_overlapping_sources(spark):
    rows = [(i, 10, ["a", "b"] if i % 2 else ["a"], i) for i in range(200)]
    rows += [(200 + i, 5, [None], i) for i in range(40)]
    table = spark.createDataFrame(rows, "n long, _size long, _sources array<string>, _id long")
    made, plan = mixing.mix(table)
    sources = {r.source: r for r in plan.sources.collect()}
    assert (sources["a"].source_size, sources["b"].source_size) == (2000, 1000)
    assert sources[None].source_size == 200
    taken = sum(r._size * r.copies for r in made.collect())
    assert abs(taken - plan.patterns.agg({"amount": "sum"}).first()[0]) <= 20


def test_very_many_sources_mix(spark):
    """Sources that overlap with none do not pass the driver."""
    table = spark.range(150_000).selectExpr(
        "id n", "id % 7 + 1 _size", "array(concat('s', id)) _sources", "id _id"
    )
    made, plan = mixing.mix(table)
    assert plan.sources.count() == 150_000
    row = made.selectExpr("sum(_size * copies) taken", "max(copies) most", "sum(_size) size").first()
    # a source of one document is taken as a whole or not at all
    assert row.most == 2 and 1.2 * row.size < row.taken <= 2 * row.size


def test_mix_query(spark, folder):
    made = queries.mixing(spark, folder).collect()
    names = {r.doc_id: r.source for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sums, targets = defaultdict(int), {}
    for r in made:
        assert 0 <= r.taken <= 2 * r.size
        sums[names[r.doc_id]] += r.taken
        targets[names[r.doc_id]] = (r.target, r.source_size)
    total = sum(size for _, size in targets.values())
    sizes = [targets[name][1] for name in sorted(targets)]
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    wanted = plain_shares(sizes, weights, 1.5 * total, 2)
    assert [targets[name][0] for name in sorted(targets)] == pytest.approx(wanted)
    assert all(abs(sums[n] - targets[n][0]) < 0.08 * targets[n][0] + 5 for n in sums)
    assert sorted(map(tuple, made)) == sorted(map(tuple, queries.mixing(spark, folder).collect()))


def test_mix_odd_rows(odd_documents, no_documents):
    made = queries.mixed_documents(odd_documents)
    assert made.columns == odd_documents.columns
    assert {r.doc_id for r in made.collect()} >= {6}
    assert queries.mixed_documents(no_documents).count() == 0


def plain_best_fit(sizes, sources, clusters, capacity):
    bins, placed = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fits = [
            (b["left"], n) for n, b in enumerate(bins)
            if b["left"] >= sizes[i] and sources[i] not in b["s"] and clusters[i] not in b["c"]
        ]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        placed[i] = (n, capacity - bins[n]["left"])
        bins[n]["left"] -= sizes[i]
        bins[n]["s"] |= {sources[i]} - {None}
        bins[n]["c"] |= {clusters[i]} - {None}
    return placed


def test_best_fit_equals_trying_every_bin():
    draw = np.random.default_rng(9)
    sizes = draw.integers(0, 60, 400).tolist()
    sources = [None if x == 0 else int(x) for x in draw.integers(0, 12, 400)]
    clusters = [int(x) for x in draw.integers(0, 150, 400)]
    assert packing.best_fit(sizes, sources, clusters, 100) == plain_best_fit(sizes, sources, clusters, 100)


def test_packing_places_everything_without_conflict(spark, folder, odd_documents, no_documents):
    for docs in (spark.read.parquet(f"{folder}/documents.parquet"), odd_documents):
        given = docs.collect()
        made = queries.packed_documents(docs).collect()
        assert sum(r.n_words for r in made) == sum(len((g.text or "").split()) for g in given if g.doc_id != 8) + sum(
            len(re.findall(r"[^\x20\x09-\x0D]+", g.text)) for g in given if g.doc_id == 8
        )
        by_id = {g.doc_id: g for g in given}
        held = defaultdict(list)
        for r in made:
            held[r.bin].append(r)
        for rows in held.values():
            rows.sort(key=lambda r: (r.offset, r.n_words))
            ends = [r.offset + r.n_words for r in rows]
            assert all(e <= r.offset for e, r in zip(ends, rows[1:])) and ends[-1] <= packing.CAPACITY
            known = [by_id[r.doc_id].source for r in rows if by_id[r.doc_id].source is not None]
            assert len(known) == len(set(known))
            texts = [by_id[r.doc_id].text for r in rows if (by_id[r.doc_id].text or "").strip()]
            assert len(texts) == len(set(texts))
    assert queries.packed_documents(no_documents).count() == 0


def plain_states(model, runs):
    """Best roles of one conversation's segments by trying every path."""
    codes = [c for codes in runs for c in codes]
    best = None
    for path in itertools.product(range(3), repeat=len(codes)):
        score = model.start(codes[0])[path[0]]
        for a, b, code in zip(path, path[1:], codes[1:]):
            score += model.step(code)[a, b]
        if best is None or score > best[0] + 1e-9:
            best = (score, path)
    return best[1]


def test_viterbi_equals_trying_every_path():
    counts = transcripts.Counts(
        np.array([1.0, 5, 0]), np.array([[0, 9.0, 1], [0, 1, 9], [0, 9, 1]]),
        np.random.default_rng(3).integers(0, 9, (3, transcripts.KINDS)).astype(float),
    )
    model = transcripts.Model.of(counts)
    text = ["hello?\nmore of it", "Assistant: an answer\nUser: then?", "ok", "a b c d e f"]
    runs = [transcripts.observations(t) for t in text]
    codes = [c for run in runs for c in run]
    assert tuple(transcripts.viterbi(model, codes, None, None)) == plain_states(model, runs)


def test_transcripts_do_not_depend_on_the_ranges(spark, folder):
    talk = spark.read.parquet(f"{folder}/conversations.parquet")
    hot = talk.selectExpr("0L conv_id", "conv_id * 100 + turn turn", "role", "text", "1 range")
    results = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows = transcripts.parse_transcripts(hot).orderBy("turn", "part").collect()
        results.append([tuple(r) for r in rows])
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert results[0] == results[1]
    assert len({r[1] for r in results[0]}) == talk.count()


def test_markers_and_odd_rows(spark):
    rows = [
        (1, 0, None, "User: hi there\nAssistant: hello\nhow are you?"),
        (1, 0, None, "User: hi there\nAssistant: hello\nhow are you?"),
        (None, None, "robot", None), (2, 1, "user", ""),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = transcripts.parse_transcripts(table).collect()
    first = [r for r in made if r.conv_id == 1]
    assert [r.role for r in first] == ["user", "assistant"] * 2
    assert first[0].text == "hi there" and first[1].rendered == "<|assistant|>\nhello\nhow are you?"
    assert len(made) == 6
    assert transcripts.parse_transcripts(table.limit(0)).count() == 0


def test_documents_without_words_share_sequences(spark):
    rows = [(i, "" if i % 2 else None, None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert queries.packed_documents(docs).select("bin").distinct().count() == 1


def test_roles_of_held_out_conversations(spark, folder):
    def learned(conv):
        return zlib.crc32(str(conv).encode()) % 3 != 1

    talk = spark.read.parquet(f"{folder}/conversations.parquet")
    roles = {(r.conv_id, r.turn): r.role for r in talk.collect()}
    made = [r for r in transcripts.parse_transcripts(talk, learned).collect() if not learned(r.conv_id)]
    right = [roles[r.conv_id, r.turn] == r.role for r in made]
    assert sum(right) > 0.85 * len(right)


def test_pipeline_stages_act(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = docs.count()
        path = scratch_path(spark, "test")
        stage(spark, docs, folder).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns and 0.7 * before < kept.count() < before
        docs = kept
    assert docs.select("text").distinct().count() == docs.count()
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    assert len(good & left) > 0.8 * len(good)
    mixed = corpus_pipeline.mixed(spark, docs, folder)
    assert mixed.columns == docs.columns
    packed = corpus_pipeline.packed(spark, mixed, folder)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in mixed.collect()}


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_pipeline_runs_on_odd_and_empty_tables(spark, odd_documents, no_documents, kind):
    """All stages one after the other; a document of the result is one that every stage kept."""
    sf_dir = scratch_path(spark, "tables")
    docs = odd_documents if kind == "odd" else no_documents
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    made = corpus_pipeline.run(spark, sf_dir).collect()
    if kind == "empty":
        assert made == []
        return
    kept = docs.where("doc_id IN (1, 2, 3, 6)").select("doc_id").distinct()
    assert {r.doc_id for r in made} <= {r.doc_id for r in kept.collect()}
    places = [(r.bin, r.offset) for r in made if r.n_words]
    assert len(places) == len(set(places))
