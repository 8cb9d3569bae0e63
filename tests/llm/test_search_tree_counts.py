"""Ranked search, Merkle manifest and token counts against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from itemwise.llm import counts, lexical, merkle, sha256
from itemwise.llm.queries import tokenizer_file

from . import cases

# --- operator 11 -----------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for i, bag in bags:
            m = 25 + 75 * sum(bag.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                    for t in terms(text) if t in bag)
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


ITEMS = [(1, "w1 w2 W3 w3"), (2, "ÑANDÚ 中文 changed"), (3, ""), (4, None), (5, "absent"), (1, "w5 w6"), (1, "w5 w6"),
         (6, "one a b c x"), (None, "w7 changed")]


@pytest.mark.parametrize("shard_postings,block_bytes", [(1 << 20, 1 << 20), (150, 8)])
def test_search_matches_brute_force(spark, shard_postings, block_bytes):
    docs = cases.frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    index = lexical.build_index(docs.repartition(3), shard_postings=shard_postings)
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id int, text string, score int")
    got = lexical.search(index, items, k=10, block_bytes=block_bytes).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_search(rows, ITEMS, 10)


def test_search_of_ties_takes_the_smaller_ids(spark):
    docs = spark.createDataFrame([(i, "same words here" if i % 3 else "other") for i in range(90, 0, -1)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    got = lexical.search(lexical.build_index(docs.repartition(5), shard_postings=20), items).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [i for i in range(1, 91) if i % 3][:10]
    assert [r.rank for r in got] == list(range(1, 11))


def test_search_skips_strata_below_the_bound(spark):
    rnd = random.Random(5)
    docs = [(i, "rare " * (i % 4 == 0) + cases.words(rnd, rnd.randrange(5, 200))) for i in range(600)]
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    table = index.table.where("term IS NULL OR term = CAST('rare' AS BINARY)").toArrow()
    strata = lexical._Strata(table, {b"rare": 0})
    visited = []
    real = strata._postings
    strata._postings = lambda s, e, w: visited.append(int((e - s).sum())) or real(s, e, w)
    strata.best(lexical._Query({0: 1}, np.array([1000])), 3)
    assert 0 < sum(visited) < len(strata.impact)


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert lexical.search(lexical.build_index(cases.empty(spark)), items).count() == 0
    found = lexical.search(lexical.build_index(cases.frame(spark)), items.limit(0))
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


# --- operator 12 -----------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_levels(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        levels.append(nodes)
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        run = level[at - at % 3:at - at % 3 + 3]
        yield run[:at % 3], run[at % 3 + 1:]
        at //= 3


def brute_manifest(rows):
    """rows (doc_id, source, lang, n_chars, text)."""
    leaves = {}
    for r in rows:
        altered = r[:4] + ((r[4] or "").replace("\n", "") if r[4] is not None else None,)
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        leaf = h(*map(field, r))
        leaves.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0, leaf), r[0], leaf,
                                           h(*map(field, altered)) if tampered else leaf))
    order = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_levels([x[2] for x in sorted(leaves[s])]) for s in order}
    top = brute_levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (_, doc, leaf, node) in enumerate(sorted(leaves[s])):
            proof = ""
            for left, right in [*siblings(trees[s], at), *siblings(top, k)]:
                proof += "".join(left + right)
                node = h(*left, node, *right)
            out.append((doc, leaf, trees[s][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(spark, docs, **sizes):
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(docs, candidate={"text": text}, **sizes)
    return sorted([(r.key, r.leaf.hex(), r.subroot.hex(), r.root.hex(), r.proof.hex(), r.folded_root.hex(),
                    r.folded_root == r.root) for r in found.collect()], key=str)


def test_sha256_states():
    rnd = random.Random(3)
    for n in (0, 1, 2, 5):
        parts = [[hashlib.sha256(rnd.randbytes(9)).digest() for _ in range(n)] for _ in range(7)]
        state = sha256.start(7)
        for k in range(n):
            state = sha256.absorb(state, sha256.hex_blocks(sha256.from_bytes(
                np.frombuffer(b"".join(p[k] for p in parts), np.uint8).reshape(-1, 32))))
        got = sha256.to_bytes(sha256.finish(state, np.full(7, n)))
        assert [g.tobytes().hex() for g in got] == [h(*[x.hex() for x in p]) for p in parts]


def test_manifest_of_awkward_rows(spark):
    docs = cases.frame(spark)
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert manifest_rows(spark, docs.repartition(3)) == brute_manifest(rows)


@pytest.mark.parametrize("levels,chunk", [(1, 4), (2, 20_000)])
def test_manifest_over_several_rounds(spark, levels, chunk):
    rows = [(i, "hot" if i % 2 else None if i % 5 == 0 else f"s{i % 37}", "en", i, f"a\nb{i}" if i % 3 else "plain")
            for i in range(260)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest_rows(spark, docs.repartition(4), levels=levels, chunk_rows=chunk) == brute_manifest(rows)


def test_manifest_sizes_around_a_block(spark):
    sizes = [1, 2, 3, 4, 728, 729, 730, 2188]
    rows = [(10_000 * k + i, f"s{k}", "en", 1, f"t\n{i}") for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest_rows(spark, docs) == brute_manifest(rows)
    alone = docs.where("source = 's4'")
    assert manifest_rows(spark, alone) == brute_manifest([r for r in rows if r[1] == "s4"])


def test_manifest_of_an_empty_table(spark):
    assert merkle.manifest(cases.empty(spark)).count() == 0


# --- operator 13 -----------------------------------------------------------------

WORD = "word_bpe_49k.json"
ODD = ["A  b\n\tC", "a b c", " a B c ", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|> Y", "H̱ ẖ ẖ",
       "don't DON'T", "ΣΣ AΣ", "İ K ﬁ", "a ́b", "  a b", "q" * 5000, "a\x1cb", "😀 İ", "a\x0bb\x0cc\x85d\u2028e\u00a0f", "x <|endoftext|>\ty", "́ ̱H Σ ΣΣ"]


def plain_count(name, text):
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        return len(SentencePieceProcessor(model_file=tokenizer_file(name)).encode(text))
    from tokenizers import Tokenizer
    return len(Tokenizer.from_file(tokenizer_file(name)).encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", [WORD, "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_match_the_library(spark, name):
    docs = cases.frame(spark).unionByName(cases.frame(spark, ODD, start=100))
    got = counts.token_counts(docs.repartition(3), tokenizer_file(name), limit=300).collect()
    want = [(r.doc_id, len((r.text or "").encode()), n := plain_count(name, r.text or ""), n > 300) for r in docs.collect()]
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)


def test_equal_normal_forms_have_equal_counts(spark):
    rnd = random.Random(11)
    alphabet = list("aAhHjJ zZ09'") + ["\n", "\t ", "́", "̱", " ", "Σ", "<|endoftext|>", "<|ENDOFTEXT|>", "'S", "İ"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(1, 5))) for _ in range(3000)]
    forms = (spark.createDataFrame([(t,) for t in texts], "t string")
             .select("t", counts.normal_form(F.col("t"), tokenizer_file(WORD)).alias("form")).collect())
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_file(WORD))
    groups = {}
    for r in forms:
        groups.setdefault(r.form, set()).add(len(tokenizer.encode(r.t, add_special_tokens=False).ids))
    assert len(groups) < len(set(texts))
    assert all(len(g) == 1 for g in groups.values())


def test_cache_is_appended_to_and_only_misses_are_encoded(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["one two", "ONE  two", "three", None])], "doc_id long, text string")
    path = tokenizer_file(WORD)
    first = counts.token_counts(docs, path, cache).collect()
    stored = spark.read.parquet(cache)
    assert stored.count() == 3 and stored.select("version").distinct().count() == 1
    # A stored count is believed: it is not computed again.
    (spark.createDataFrame([(counts.version_of(path), bytearray(hashlib.sha256(b"four").digest()), 77)], counts.STORED)
     .write.mode("append").parquet(cache))
    more = docs.unionByName(spark.createDataFrame([(10, "four"), (11, "five six")], "doc_id long, text string"))
    second = {r.doc_id: r.n_tokens for r in counts.token_counts(more, path, cache).collect()}
    assert {r.doc_id: r.n_tokens for r in first}.items() <= second.items()
    assert second[10] == 77 and second[11] == 2
    assert spark.read.parquet(cache).count() == 5
    # Another tokenizer has another version and shares nothing.
    other = counts.token_counts(docs, tokenizer_file("byte_bpe_50k.json"), cache).collect()
    assert len(other) == 4 and spark.read.parquet(cache).select("version").distinct().count() == 2


@pytest.mark.parametrize("few", [0, 200_000])
def test_many_and_few_misses(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(counts, "FEW_DIGESTS", few)
    cache, path = str(tmp_path / "cache"), tokenizer_file(WORD)
    docs = cases.frame(spark)
    counts.token_counts(docs.limit(5), path, cache).collect()
    got = counts.token_counts(docs, path, cache).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted(
        (str(r.doc_id), plain_count(WORD, r.text or "")) for r in docs.collect())


def test_hot_texts_and_empty_table(spark):
    docs = spark.createDataFrame([(i, "copy copy" if i % 2 else f"text {i}") for i in range(2500)], "doc_id long, text string")
    got = counts.token_counts(docs, tokenizer_file(WORD)).collect()
    assert len(got) == 2500 and {r.n_tokens for r in got if r.doc_id % 2} == {2}
    assert counts.token_counts(cases.empty(spark), tokenizer_file(WORD)).count() == 0
