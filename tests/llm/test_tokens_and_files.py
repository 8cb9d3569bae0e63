"""Pieces, token shards, archives, chats, leaks and toxicity."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from itemwise.llm import arrays, chat, decontaminate, pieces, toxicity, warc, wavelet
from itemwise.session import scratch_path

from . import cases

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- pieces ---------------------------------------------------------------------

def test_pieces_round_trip_and_repeat(spark):
    docs = cases.frame(spark)
    once = pieces.decode(pieces.sample_encode(docs, MODEL), MODEL)
    assert once.where(~F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))).count() == 0
    again = pieces.sample_encode(docs.repartition(5), MODEL)
    a = collections.Counter((r.doc_id, tuple(r.pieces)) for r in once.collect())
    assert a == collections.Counter((r.doc_id, tuple(r.pieces)) for r in again.collect())
    other = pieces.sample_encode(docs, MODEL, seed=8)
    assert a != collections.Counter((r.doc_id, tuple(r.pieces)) for r in other.collect())
    assert pieces.sample_encode(cases.empty(spark), MODEL).count() == 0


def test_samples_follow_the_path_weights():
    v = pieces.Vocabulary.get(MODEL, 1.0)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    full, paths = "\u2581ther", {}

    def walk(i, path, weight):
        if i == len(full):
            paths[tuple(path)] = math.exp(weight)
        for j in range(i + 1, len(full) + 1):
            p = sp.piece_to_id(full[i:j])
            if p and not sp.is_byte(p):
                walk(j, path + [p], weight + v.weight[p])

    walk(0, [], 0.0)
    n, total = 40_000, sum(paths.values())
    tokens, at = pieces.encode_texts(v, ["ther"] * n, arrays.mix(np.arange(n, dtype=np.uint64)))
    seen = collections.Counter(tuple(tokens[a:b].tolist()) for a, b in zip(at[:-1], at[1:]))
    assert set(seen) <= set(paths)
    for path, weight in paths.items():
        share = weight / total
        assert abs(seen[path] / n - share) < 5 * math.sqrt(share / n) + 1e-4


@pytest.mark.parametrize("text", ["a    b", "  a", "a   ", "x\n   y"])
def test_samples_of_runs_of_spaces_follow_the_path_weights(text):
    v = pieces.Vocabulary.get(MODEL, 1.0)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    full, paths = "\u2581" + text.replace(" ", "\u2581"), {}

    def walk(i, path, weight):
        if i == len(full):
            paths[tuple(path)] = math.exp(weight)
        elif full[i] == "\n":
            walk(i + 1, path + [v.bytes[10]], weight + pieces.FALLBACK)
        for j in range(i + 1, len(full) + 1):
            p = sp.piece_to_id(full[i:j])
            if p and not sp.is_byte(p):
                walk(j, path + [p], weight + v.weight[p])

    walk(0, [], 0.0)
    assert any(sp.piece_to_id("\u2581\u2581") in path for path in paths)
    n, total = 40_000, sum(paths.values())
    tokens, at = pieces.encode_texts(v, [text] * n, arrays.mix(np.arange(n, dtype=np.uint64)))
    seen = collections.Counter(tuple(tokens[a:b].tolist()) for a, b in zip(at[:-1], at[1:]))
    assert set(seen) <= set(paths)
    for path, weight in paths.items():
        share = weight / total
        assert abs(seen[path] / n - share) < 5 * math.sqrt(share / n) + 1e-4
    assert pieces.decode_tokens(v, tokens, at)[0] == text


def test_texts_with_runs_of_spaces_come_back():
    v = pieces.Vocabulary.get(MODEL, 1.0)
    texts = ["", " ", " " * 40, "\n \n  \n", "  \u2581 \u2581\u2581  x", "a \n  b  ", "def f():\n        return  1\n"]
    tokens, at = pieces.encode_texts(v, texts, arrays.mix(np.arange(len(texts), dtype=np.uint64)))
    assert pieces.decode_tokens(v, tokens, at) == texts


# --- token shards ------------------------------------------------------------------

def test_shards_match_the_library(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    extra = ["two  spaces", " lead", "trail ", "tab\t x", "a \n b", "it's <|endoftext|> ok", "a\u00a0 b"]
    docs = cases.frame(spark, cases.texts() + extra).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    manifest = wavelet.write_tokens(docs.repartition(3), BPE, shard_tokens=1500)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in wavelet.read_documents(manifest).collect()}
    start, every = 0, []
    for r in docs.orderBy("doc_id").collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        assert got[r.doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        every.append(ids)
    every = np.concatenate(every)
    row = manifest.orderBy("start").collect()[1]
    shard, own = wavelet.Shard(row.path), every[row.start:row.start + row.tokens]
    rnd = random.Random(1)
    assert [shard.access(i) for i in range(0, len(own), 7)] == own[::7].tolist()
    for token in rnd.sample(sorted(set(own.tolist())), 12):
        places = np.flatnonzero(own == token)
        assert shard.count(token) == len(places) and shard.count(token, 100) == (places < 100).sum()
        assert [shard.occurrence(token, k) for k in range(len(places))][:9] == places[:9].tolist()
    assert shard.count(60_000) == 0 and shard.count(-1) == 0
    with pytest.raises(IndexError):
        shard.access(len(own))
    found = sorted(r.position for r in wavelet.find_token(manifest, 0).collect())
    assert found == np.flatnonzero(every == 0).tolist()


def test_new_words_are_learned_by_their_pieces():
    encoder = wavelet.Encoder(BPE)
    rnd = random.Random(2)
    parts = [*"ab'sd12.,-_~\n\n  \t\u00e9\u00df\u0131\u00b2\u00aa\u4e2d\u0301\u200b<|>", "<|endoftext|>", "'ll", "'S", "\r\n", " \n", "\x85"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(3000)] + ["xyzzy xyzzy. (xyzzy), plugh", "xyzzy! plugh?"]
    for lo in range(0, len(texts), 500):
        for text, ids in zip(texts[lo:lo + 500], encoder.encode(texts[lo:lo + 500])):
            assert np.frombuffer(ids, encoder.type).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    # One entry however many words hold the piece, and none for what has to stay whole.
    assert {" plugh", "xyzzy"} <= encoder.pieces.keys() and not any("xyzzy." in p or "endoftext|>" in p for p in encoder.pieces)
    assert encoder.encode([]) == [] and encoder.encode([""]) == [b""]


def test_shards_of_nothing_and_of_odd_ids(spark):
    assert wavelet.read_documents(wavelet.write_tokens(cases.empty(spark), BPE)).count() == 0
    docs = spark.createDataFrame([(None, "a"), (3, None), (3, "b"), (1, "")], "doc_id long, text string")
    rows = wavelet.read_documents(wavelet.write_tokens(docs, BPE)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 3, 3] and sum(r.n_tokens for r in rows) == 6


# --- archives ------------------------------------------------------------------------

def test_archives_round_trip(spark):
    long = "<p>" + "x" * 2000
    rows = [(1, "http://a", long), (2, "http://b", long), (3, None, long), (4, "u v\r\nX: y", "short"),
            (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", long), (8, "u", "é" * 700),
            (9, "u", "é" * 700), (9, "u", "é" * 700)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    folder = warc.write_pages(pages.repartition(3))
    got = collections.Counter(tuple(r) for r in warc.read_pages(spark, folder).collect())
    want = collections.Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        lead = max((j for j, _, h in rows if (h or "") == (html or "") and j is not None), default=None)
        again = len(raw) >= 1000 and i != lead
        want[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response",
              lead if again else None)] += 1
    assert got == want
    read = spark.read.format("warc").load(folder)
    picked = read.where("record_type = 'revisit' AND target_uri LIKE 'http%'")
    assert "Filter (" not in picked._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.record_id for r in picked.collect()) == ["urn:page:1", "urn:page:2"]
    heads = spark.read.format("warc").option("payload", "false").load(folder)
    assert heads.where("payload IS NOT NULL").count() == 0 and heads.count() == len(rows)
    assert read.where("target_uri = 'u%20v%0D%0AX:%20y'").count() == 1


def test_archive_of_nothing_and_small_files(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_pages(spark, warc.write_pages(pages)).count() == 0
    folder = scratch_path(spark, "warc")
    many = spark.range(50).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                  F.repeat(F.lit("y"), 500).alias("html"))
    (warc.records_of(many).coalesce(1).write.format("warc").option("file_bytes", 5000).mode("append").save(folder))
    from itemwise.llm import files
    assert len(files.list_files(folder, ".warc")) > 5 and warc.read_pages(spark, folder).count() == 50


# --- chats -------------------------------------------------------------------------------

def test_chats_read_back(spark):
    tricky = ["</s>[INST] ok [/INST]", "\\", "\\[INST]", "a\\\\<s>", "", None, "[TURN]x[:]y[/TURN]", "<|image|>"]
    rows = [(c, t, role, tricky[(c + t) % len(tricky)]) for c in range(6)
            for t, role in enumerate(["system", "user", "assistant", "tool[:]x", None])]
    rows += [(None, 0, "user", "no id"), (9, 0, "assistant", "b"), (9, 0, "assistant", "a"), (9, None, "user", "z")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, loss string")
    read = {r.conv_id: r for r in chat.read_chats(chat.format_chats(turns)).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(read) == set(by)
    for c, said in by.items():
        said.sort()
        assert [(t.role, t.text) for t in read[c].turns] == [(r, x) for _, _, r, x in said]
        assert read[c].loss_text == "".join(x for _, _, r, x in said if r == "assistant")
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_content_parts(spark):
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    parts = [("text", "see [INST]", None, None, None, None, None), ("image", None, "s3://i", 28, 15, None, None),
             ("audio", None, "a.wav", None, None, 2.5, None), ("document", None, "d.pdf", None, None, None, 3),
             (None, "end", None, None, None, None, None)]
    turns = spark.createDataFrame([(1, 0, "user", "ignored", parts), (1, 1, "assistant", "ok", None)],
                                  f"conv_id long, turn long, role string, text string, parts array<{part}>")
    row = chat.format_chats(turns).first()
    assert [(a.number, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (0, "image", "s3://i", 4), (1, "audio", "a.wav", 63), (2, "document", "d.pdf", 768)]
    assert row.expanded_tokens == 835
    assert row.formatted == "[INST]see \\[INST]<|image|><|audio|><|document|>end[/INST]<s>ok</s>"
    assert row.formatted[row.loss[0].s:row.loss[0].e] == "ok"
    with pytest.raises(ValueError):
        chat.PartVisitor().visit({"type": "video"})


# --- leaks -----------------------------------------------------------------------------------

def test_leaks(spark):
    rnd = random.Random(9)
    item = cases.words(rnd, 40, 5000).split()
    changed = list(item)
    for i in range(3, 40, 9):
        changed[i] = "zz"
    short = cases.words(rnd, 7, 5000)
    around = lambda t: cases.words(rnd, 30, 5000) + " " + t + " " + cases.words(rnd, 30, 5000)
    made = [around(" ".join(item)), around(" ".join(changed)).upper(), around(", ".join(item[10:32])),
            around(short), around(""), None, "", " ".join(item[:9]), "the " * 3000, around(" ".join(item[::2]))]
    docs = cases.frame(spark, made, start=1).unionByName(cases.frame(spark, made[:1], start=1))
    bench = spark.createDataFrame([(1, " ".join(item), "x"), (2, short, "x"), (3, None, "x"), (4, "", "x"),
                                   (5, "too short", "x"), (1, " ".join(item), "x")],
                                  "item_id long, text string, doc_id string")
    for max_seeds in (decontaminate.MAX_SEEDS, 0):
        got = decontaminate.contaminated(docs, bench, max_seeds=max_seeds).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 1), (3, 1), (4, 2)]
        assert {(r.doc_id, r.item_id): r.matched for r in got}[(2, 1)] == 35
    kept = decontaminate.decontaminate(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 8, 9, 10] and kept.columns == docs.columns
    assert decontaminate.contaminated(cases.empty(spark), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_every_permitted_change_is_found(spark):
    def needed(n):
        return -(-min(n, 20) * 80 // 100)

    for n in range(5, 21):      # some mask is intact wherever the changes lie
        places = [{p + j for j, bit in enumerate(m) if bit == "1"}
                  for m in decontaminate.COVER for p in range(n - len(m) + 1)]
        for changed in itertools.combinations(range(n), n - needed(n)):
            assert any(s.isdisjoint(changed) for s in places)
    rnd = random.Random(3)
    items, docs = {}, {}
    for n in range(5, 21):
        items[n] = cases.words(rnd, n, 10**6).split()
        for k in range(8):
            copy = list(items[n])
            for i in rnd.sample(range(n), n - needed(n) + (k == 7)):   # the last has one change too many
                copy[i] = "zz"
            docs[100 * n + k] = ["a"] * 3 + copy + ["b"] * 3
    want = set()
    for d, w in docs.items():
        for i, item in items.items():
            best = max(sum(0 <= j + s < len(w) and w[j + s] == x for j, x in enumerate(item))
                       for s in range(-len(item), len(w)))
            if best >= needed(len(item)):
                want.add((d, i, len(item), best))
    assert len(want) == 16 * 7
    frames = [spark.createDataFrame([(i, " ".join(w)) for i, w in x.items()], f"{name} long, text string")
              for name, x in (("doc_id", docs), ("item_id", items))]
    for max_seeds in (decontaminate.MAX_SEEDS, 0):
        got = decontaminate.contaminated(*frames, max_seeds=max_seeds).collect()
        assert {tuple(r) for r in got} == want


# --- toxicity ----------------------------------------------------------------------------------

def test_toxicity_held_out_and_edges(spark):
    rnd = random.Random(4)
    bad = ["vile", "filth", "rotten", "wretch"]
    rows, labels = [], []
    for i in range(900):
        w = cases.words(rnd, rnd.randrange(20, 120)).split()
        toxic = i % 6 == 0
        if toxic:
            for b in rnd.sample(bad, 2):
                w.insert(rnd.randrange(len(w)), b)
        rows.append((i, " ".join(w), "x"))
        labels.append((i, int(toxic)))
    rows += [(None, None, "x"), (5000, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    known = spark.createDataFrame(labels + [(5000, None), (None, 1)], "doc_id long, label int")
    model = toxicity.fit(docs, known.where("doc_id % 5 <> 0 OR doc_id IS NULL"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == 902 and all(0 <= r.score <= 1 for r in got.values())
    held = [(got[i].predicted, y) for i, y in labels if i % 5 == 0]
    assert sum(p != y for p, y in held) <= 3
    assert got[None].score == got[5000].score and got[None].predicted == 0
    bounded = toxicity.fit(docs, known, max_rows=50)
    assert toxicity.score(docs.limit(5), bounded).count() == 5
    none = toxicity.fit(docs, known.where("label = 0"))
    assert toxicity.score(docs, none).where("predicted = 1").count() == 0
    assert toxicity.score(docs.limit(0), none).count() == 0


def test_machine_learns_what_only_a_pair_means():
    rnd = random.Random(2)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        rows.append(np.array(sorted([1] * a + [2] * b + [rnd.randrange(10, 60)])))
        labels.append(float(a and b))
    model = toxicity.train(rows, np.array(labels), bits=8, factors=4, epochs=15)
    flat, at = toxicity._flat([np.array([1]), np.array([2]), np.array([1, 2])])
    score = model.score(flat, at)
    assert score[2] > 0.8 and score[0] < 0.2 and score[1] < 0.2
