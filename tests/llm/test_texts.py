"""Operators on texts against brute force, over prose and odd texts."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keycadence.llm import bpe, licences, lm, neardup, packing, passages, pii, quality
from keycadence.llm.components import components

from . import brute


def test_quality_counts(docs, texts, none):
    rows = quality.quality_report(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert found == brute.quality(texts[r.doc_id])
        n, repeat = found[0], found[4]
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert not (r.kept and r.base_failed)
    assert quality.quality_report(none).count() == 0


def test_quality_order_changes_no_verdict(docs):
    orders = [quality.RULES, quality.RULES[::-1]]
    text = F.coalesce("text", F.lit(""))
    found = [
        docs.filter(
            quality.verdict(quality.Measures(text, quality.words(text)), list(rules)).isNull()
        ).select("doc_id").collect()
        for rules in orders
    ]
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert sorted(found[0]) == sorted(found[1]) == sorted(kept.select("doc_id").collect())


def test_near_duplicates(docs, texts, none):
    wanted = brute.near_components(dict(enumerate(texts)), 4)
    rows = neardup.near_duplicates(docs, width=4).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id) == wanted[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)
    assert neardup.near_duplicates(none).count() == 0
    kept = neardup.dedup_filter(docs, width=4)
    assert kept.columns == docs.columns
    assert kept.count() == sum(i == c for i, (_, c) in wanted.items())


def test_near_duplicates_without_or_with_repeated_ids(spark):
    same = "one two three four five six seven"
    rows = [(None, same), (None, same), (3, same), (3, same), (3, "other words stand here now"), (7, same)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r.doc_id or -1, r.component_id or -1, r.kept) for r in found.collect()))
    assert got == [(-1, -1, True)] * 2 + [(3, 3, True)] * 3 + [(7, 3, False)]


def test_components_of_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)] + [(101, 102), (300, 300)]
    links = spark.createDataFrame(chain + star, "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def test_exact_passages(docs, texts, none):
    wanted = brute.repeated(dict(enumerate(texts)))
    got = {i: [False] * len(x) for i, x in wanted.items()}
    rows = passages.repeated_passages(docs).collect()
    for r in rows:
        assert r.n_words == r.end_word - r.start_word >= 50 or not r.exact
        if r.exact:
            got[r.doc_id][r.start_word : r.end_word] = [True] * r.n_words
    assert got == wanted
    assert passages.repeated_passages(none).count() == 0


def test_near_passage_and_cut(spark, texts):
    base = max(texts, key=lambda t: len(t or "")).split()
    passage = base[:120]
    changed = [*passage[:60], "changed", *passage[61:]]
    rows = [
        (1, " ".join(base[500:560] + passage)),
        (2, " ".join(base[600:640] + changed + base[700:720])),
        (3, "  ".join(base[800:840])),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.repeated_passages(frame).collect()
    assert {(r.doc_id, r.source_id) for r in found} == {(2, 1)}
    left = {r.doc_id: r.text for r in passages.passage_filter(frame).collect()}
    assert left[1] == rows[0][1] and left[3] == rows[2][1]
    assert left[2].split()[:40] == base[600:640] and left[2].split()[-20:] == base[700:720]
    assert len(left[2].split()) < 80


def _shingled(words):
    codes = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
    return passages.shingles(codes, passages.SHINGLE)


def test_single_edits_at_every_place():
    for n in (50, 57, 60, 70, 80):
        words = [f"w{i}" for i in range(n)]
        for place in range(n):
            other = [*words[:place], "edited", *words[place + 1 :]]
            for more in ([], [f"x{i}" for i in range(40)]):
                a = _shingled([*more, *other, *(w + "y" for w in more)])
                b = _shingled([*(w + "z" for w in more), *words, *(w + "q" for w in more)])
                spans = passages.similar_spans(a, b, 46)
                assert spans and all(size >= 46 for _, size in spans)
                covered = {k for s, size in spans for k in range(s, s + size + 4)}
                # the longer part of the passage is found whole, at least
                assert len(covered & set(range(len(more), len(more) + n))) >= 45


def test_two_edited_passages_on_one_diagonal():
    head, foot = ([f"{c}{i}" for i in range(70)] for c in "hf")
    edit = lambda x: [*x[:35], "edited", *x[36:]]
    for gap in (30, 200):
        a = _shingled([*edit(head), *(f"own{i}" for i in range(gap)), *edit(foot)])
        b = _shingled([*head, *(f"other{i}" for i in range(gap)), *foot])
        spans = passages.similar_spans(a, b, 46)
        assert sorted(spans) == [(0, 66), (70 + gap, 66)]


def test_near_passage_whose_keys_belong_to_another(spark):
    rng = np.random.default_rng(11)
    fresh = lambda n: [f"v{x}" for x in rng.integers(0, 1 << 40, n)]
    passage = fresh(60)
    other = [*passage[:30], "edited", *passage[31:]]
    hub = []
    for fn in range(passages.FUNCTIONS):
        for keys in (passage, other):
            def ranks(words, fn=fn):
                runs = passages.Runs(pa.array([" ".join(words)]), 50)
                return passages.mixed(runs.values ^ passages.mixed(np.array([fn + 1], np.uint64)))

            at = int(np.argmin(ranks(keys)))
            while True:
                part = [*fresh(45), *keys[at : at + 5]]
                if np.argmin(ranks(part)) == 45:
                    break
            hub += part
    rows = [(1, " ".join(hub)), (2, " ".join(fresh(70) + passage)), (3, " ".join(fresh(90) + other))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.repeated_passages(frame).collect()
    assert {(r.doc_id, r.source_id, r.start_word, r.end_word) for r in found} == {(3, 2, 90, 150)}


def test_texts_under_one_id(spark):
    """Spans are about one text of an id and cut there only; equal rows are cut alike."""
    word = lambda c, n: [f"{c}{i}" for i in range(n)]
    passage, own = word("p", 60), word("own", 200)
    rows = [
        (0, " ".join(passage)), (1, " ".join(word("x", 50) + passage)), (1, " ".join(own)),
        (2, " ".join(passage + word("y", 30))), (2, " ".join(passage + word("y", 30))),
        (3, None), (3, " ".join(word("z", 70) + passage)), (None, " ".join(passage)),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.start_word, r.end_word) for r in passages.repeated_passages(frame).collect()}
    assert found == {(2, 0, 60), (3, 70, 130)}
    kept = sorted((str(r.doc_id), len((r.text or "").split())) for r in passages.passage_filter(frame).collect())
    assert kept == sorted([
        ("0", 60), ("1", 110), ("1", 200), ("2", 30), ("2", 30), ("3", 0), ("3", 70), ("None", 60)])


def test_recall_of_planted_near_passages(spark):
    """Copies at similarity 0.8 to 0.97 among frequent phrases, each held by two documents."""
    rng = np.random.default_rng(21)
    fresh = lambda n: [f"v{x}" for x in rng.integers(0, 1 << 40, n)]
    phrases = [fresh(8) for _ in range(5)]
    prose = lambda n: [w for _ in range(n) for w in [*fresh(12), *phrases[rng.integers(5)]]]
    rows, planted = [], {}
    for k in range(120):
        passage, copy = fresh(int(rng.integers(52, 160))), None
        while copy is None:
            copy = list(passage)
            for at in rng.integers(0, len(copy), rng.integers(1, 1 + len(copy) // 40 + 1)):
                copy[at] = "edited"
            one, two = (set(_shingled(x).tolist()) for x in (passage, copy))
            copy = copy if len(one & two) >= 0.8 * len(one | two) else None
        head = prose(int(rng.integers(1, 6)))
        rows.append((2 * k, " ".join(prose(3) + passage + prose(2))))
        rows.append((2 * k + 1, " ".join(head + copy + prose(2))))
        planted[2 * k + 1] = (len(head), len(head) + len(copy))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    covered = {}
    for r in passages.repeated_passages(frame).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    hit = [len(covered.get(i, set()) & set(range(a, b))) >= 0.7 * (b - a) for i, (a, b) in planted.items()]
    assert np.mean(hit) >= 0.95
    assert not any(i % 2 == 0 and len(x) > 20 for i, x in covered.items())


def test_spans_that_outgrow_the_margin(spark, monkeypatch):
    monkeypatch.setattr(passages, "MARGIN", 2)
    rng = np.random.default_rng(5)
    long = [f"v{x}" for x in rng.integers(0, 1 << 40, 3000)]
    other = [w if i % 31 else f"{w}e" for i, w in enumerate(long)]
    rows = [(1, " ".join(long)), (2, " ".join(["a", *other]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {k for r in passages.repeated_passages(frame).collect() for k in range(r.start_word, r.end_word)}
    assert len(found) > 2950


def test_windows_cover_each_run():
    rng = np.random.default_rng(3)
    for _ in range(30):
        values = rng.integers(0, 50, 80)
        left, right = passages.extents(values)
        for i in range(len(values)):
            window = values[left[i] : right[i] + 1]
            assert left[i] <= i <= right[i] and values[i] == window.min()


def test_personal_data(docs, texts, none):
    rows = pii.found_spans(docs, ["doc_id"]).select("doc_id", pii.listed(F.col("base")).alias("b"))
    for r in rows.collect():
        assert r.b == ",".join(brute.personal(texts[r.doc_id]))
    assert pii.redacted(none).columns == none.columns and pii.redacted(none).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    rows = [
        (i, f"word{i} please call me {'' if i % 10 == 0 else '+1 '}555 000 {1000 + i} now thanks", i)
        for i in range(80)
    ]
    rows.append((99, "room 555 000 1234 is free", 0))
    out = {r.doc_id: r.text for r in pii.redacted(
        spark.createDataFrame(rows, "doc_id long, text string, start int")
    ).collect()}
    assert out[3] == "word3 please call me [PHONE] now thanks"
    assert out[10] == "word10 please call me [PHONE] now thanks"
    assert out[99] == rows[-1][1]


def test_contexts_discover_obfuscated_addresses(spark):
    hidden = ["john(at)example.com", "john[at]example.com", "john (at) example.com", "a(at)b@host"]
    rows = [(i, f"word{i} please write to user{i}@example.com soon many thanks") for i in range(80)]
    rows += [(100 + i, f"word{i} please write to {x} soon many thanks") for i, x in enumerate(hidden)]
    rows.append((200, "meet us(at)noon today"))
    out = {r.doc_id: r.text for r in pii.redacted(
        spark.createDataFrame(rows, "doc_id long, text string")
    ).collect()}
    for i in range(len(hidden)):
        assert out[100 + i] == f"word{i} please write to [EMAIL] soon many thanks"
    assert out[200] == rows[-1][1]


def test_bpe_equals_tiktoken(docs, texts, none):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks, _ = bpe.vocabulary(path)
    other = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    for r in bpe.decode(bpe.encode(docs, path), path).collect():
        assert r.ids == other.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    assert bpe.encode(none, path).count() == 0


def test_words_joined_by_any_white_space():
    parts = ["a", "Zoë", "1234", "it's", "x.", "(y)", "\u00a0", "\x85", "\x1c", "<|endoftext|>", "日本", "Ġ", "é\u0301"]
    gaps = [" ", "  ", "   ", "\n", " \n", "\n ", "\r\n", "\t", " \t ", "\u3000", "", " \n\n "]
    chosen = random.Random(7)
    texts = ["", " ", "\n", "  a", "a ", "a  ", None]
    for size in (1, 2, 3, 5, 9, 40) * 60:
        text = "".join(chosen.choice(parts) + chosen.choice(gaps) for _ in range(size))
        texts.append(chosen.choice(["", " ", "\n "]) + text.rstrip(chosen.choice(["", " ", "\n"])))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    ranks = bpe.vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))[0]
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for encoder, expected in (
        (packing._encoder(public_tokenizers.path("byte_bpe_50k.json")),
         lambda t: library.encode(t, add_special_tokens=False).ids),
        (bpe._encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), plain.encode_ordinary),
    ):
        ids, ends = encoder.encode(pa.array(texts))
        for text, a, b in zip(texts, ends, ends[1:], strict=False):
            assert ids[a:b].tolist() == expected(text or ""), repr(text)


def test_packing(docs, texts, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rows = packing.packed_documents(docs, path).toPandas()
    total = 0
    for doc_id, pieces in rows.sort_values("piece").groupby("doc_id"):
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        assert list(pieces["start"]) == list(np.cumsum([0, *pieces["length"]])[:-1])
        assert pieces["length"].sum() == len(ids) and set(pieces["length"][1:]) <= {2048}
        for p in pieces.itertuples():
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert zlib.crc32(part) == p.ids_crc32
    assert rows["doc_id"].nunique() == len(texts)
    for _, group in rows.sort_values("offset").groupby("sequence_id"):
        assert list(group["offset"]) == list(np.cumsum([0, *group["length"]])[:-1])
        assert group["length"].sum() <= 2048
    assert rows["sequence_id"].nunique() <= -(-total // 2048) + 1
    assert packing.packed_documents(none, path).count() == 0


def test_plan_holds_every_length():
    rng = np.random.default_rng(2)
    for capacity in (10, 64):
        need = rng.integers(0, 40, capacity + 1)
        need[0] = 0
        chosen = packing.plan(need, capacity)
        sizes = np.arange(capacity + 1)
        assert (sum(c * n for c, n in chosen) == need).all()
        assert all((c * sizes).sum() <= capacity for c, _ in chosen)
        assert sum(n for _, n in chosen) <= 1.1 * (need * sizes).sum() / capacity + 1


def test_language_model(docs, texts, none):
    rows = lm.text_scores(docs).toPandas().set_index("doc_id").sort_index()
    tokens = [[*brute.words(t), b"\n"] for t in texts]
    train = [zlib.crc32(str(i).encode()) % 10 != 0 for i in range(len(texts))]
    counts = {}
    for own, keep in zip(tokens, train, strict=True):
        for w in own if keep else ():
            counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    for i, own in enumerate(tokens):
        r = rows.loc[i]
        base = sum(np.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert r.n_tokens == len(own) and r.n_known == sum(w in counts for w in own)
        assert r.train_tokens == total and r.held_out == (not train[i])
        assert abs(r.base_score - base) < 1e-6 * abs(base) and -np.inf < r.score < 0
    again = lm.text_scores(docs.coalesce(3)).toPandas().set_index("doc_id").sort_index()
    assert np.allclose(again["score"], rows["score"])
    assert lm.text_scores(none).count() == 0


def test_language_model_knows_the_word_before(spark):
    pair = "alpha beta gamma delta epsilon"
    rows = [(i, pair) for i in range(60)]
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows += [(held[0], pair), (held[1], "delta alpha epsilon beta gamma")]
    got = {r.doc_id: r for r in lm.text_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]].held_out and got[held[1]].held_out
    assert abs(got[held[0]].base_score - got[held[1]].base_score) < 1e-9
    assert got[held[0]].score > got[held[1]].score + 3


def test_predictive_probabilities_sum_to_one():
    keys = np.array([0x1234 << 8 | c for c in (97, 98, 99)])
    model = lm.fitted(keys, np.array([5, 3, 1]), None, 1)
    for context in (0, 0x1234, 0xFFFF):
        every = (context << 8) | np.arange(256)
        assert abs(model.probability(every).sum() - 1) < 1e-9


def _template(name, start=""):
    return next(t for n, t in licences.TEMPLATES if n == name and t.startswith(start))


def test_licenses(spark, none):
    gpl = _template("GPL-3.0-or-later", "This program")
    header = "#!/bin/sh\n#\n" + "".join(
        f"# {' '.join(gpl.split()[i : i + 9])}\n" for i in range(0, len(gpl.split()), 9)
    ) + "#\n# and WITHOUT ANY WARRANTY\n"
    mit = _template("MIT", "Permission")
    rows = [
        (1, "Some prose.\nReleased under the MIT License.", {"MIT"}),
        (2, "released UNDER the -- mit license!", {"MIT"}),
        (3, "under the bridge of the sea", set()),
        (4, None, set()),
        (5, "Licensed under CC BY-NC 4.0.\n\n" + mit.replace("copies", "copies\n"), {"CC-BY-NC-4.0", "MIT"}),
        (6, gpl + "".join(f" w{i}" for i in range(400)), {"GPL-3.0-or-later"}),
        (7, _template("LGPL-2.1-or-later", "This library"), {"LGPL-2.1-or-later"}),
        (8, _template("AGPL-3.0-or-later", "This program"), {"AGPL-3.0-or-later"}),
        (9, header, {"GPL-3.0-or-later"}),
        (10, "Released under the MIT License." + " " * 6000, {"MIT"}),
        (11, "Released under" + " " * 6000 + "the MIT License.", {"MIT"}),
        (12, "x" * 70_000 + " word" * 20_000 + "\n" + mit + " word" * 20_000, {"MIT"}),
        (13, "." * 50_000 + "a Released under the MIT License", {"MIT"}),
        (14, "word", set()),
        (14, "word", set()),
        (None, "", set()),
    ]
    frame = spark.createDataFrame([r[:2] + (0,) for r in rows], "doc_id long, text string, licenses int")
    found = licences.license_scan(frame)
    got = [(r.doc_id, {x.license for x in r.licenses}) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(i, names) for i, _, names in rows], key=str)
    assert licences.license_scan(none).count() == 0
    assert licences.license_scan(frame, templates=[]).filter("size(licenses) > 0").count() == 0


def test_licenses_against_brute_force(spark, docs, texts):
    """Every text, and texts mixed from changed templates, over all windows."""
    rng = random.Random(9)
    mixed = []
    for _, text in licences.TEMPLATES:
        w = text.split()
        for _ in range(1 + len(w) // 12):
            w[rng.randrange(len(w))] = rng.choice(["software", "the", "word", "License"])
        mixed.append(" ".join([*rng.choices(["under", "the", "prose"], k=9), *w, "tail of it", *w[:9], text]))
    every = [*texts, *mixed]
    frame = spark.createDataFrame(list(enumerate(every)), "doc_id int, text string")
    for r in licences.license_scan(frame).collect():
        got = [(x.license, round(x.dice, 9), x.start, x.stop) for x in r.licenses]
        assert got == brute.licences(every[r.doc_id], licences.TEMPLATES, licences.LEAST), r.doc_id


def test_license_templates_of_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.0").write_text("You may do with these words\nwhatever you like to do.")
    listed = licences.read_templates(spark, str(tmp_path))
    frame = spark.createDataFrame([("so you may do with these words whatever you like to do",)], "text string")
    found = licences.license_scan(frame, templates=listed).first().licenses
    assert [(x.license, x.start, x.stop, x.dice) for x in found] == [("Own-1.0", 1, 12, 1.0)]


def test_hash_of_listed_spans(docs, texts):
    found = pii.found_spans(docs, ["doc_id"]).select(
        "doc_id", F.sha2(pii.listed(F.col("base")), 256).alias("h")
    )
    for r in found.collect():
        assert r.h == hashlib.sha256(",".join(brute.personal(texts[r.doc_id])).encode()).hexdigest()
