"""Operators on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from hitparade.llm import (
    components,
    decontamination,
    license_scan,
    license_templates,
    line_dedup,
    near_dedup,
    packing,
    quality,
    spans,
    suffix_dedup,
    token_counts,
    token_files,
    tokens,
    url_filter,
    words,
)
from hitparade.llm.elias_fano import EliasFano
from hitparade.llm.queries import URL_RULES, definition, packed
from tests.conftest import SMALL
from tests.llm import brute


def rows(df, *columns):
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r))


def ordered(found):
    return sorted(found, key=lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r))


@pytest.fixture(scope="module")
def edges(documents, edge_rows):
    return documents(edge_rows)


@pytest.fixture(scope="module")
def empty(documents):
    return documents([])


def read_back(spark, docs, path):
    token_files.write_token_file(docs, definition("word_bpe_49k.json"), path)
    starts = token_files.segment_starts(spark, path)
    return token_files.read_token_file(spark, path).join(starts, ["part", "segment_no"])


def test_token_files(spark, edges, edge_rows, empty, tmp_path):
    found = read_back(spark, edges, f"{tmp_path}/a").collect()
    by_place = sorted(found, key=lambda r: r["segment_start"] + r["local_start"])
    at = 0
    for r in by_place:
        assert r["segment_start"] + r["local_start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    assert [r["doc_id"] for r in by_place] == [i for i, _ in sorted(edge_rows, key=lambda x: brute.first_key(x[0]))]
    expected = sorted((n, c) for _, _, n, c in brute.token_files([(0, t) for _, t in edge_rows if t is not None]))
    plain = sorted((r["n_tokens"], zlib.crc32(r["ids"])) for r in found)
    blank = (1, brute.crc([2]))
    assert plain == sorted([*expected, *[blank] * sum(t is None for _, t in edge_rows)])
    assert read_back(spark, empty, f"{tmp_path}/b").count() == 0
    segment = token_files.Segment(spark.read.parquet(f"{tmp_path}/a").where("n_documents > 1").first()["segment"])
    whole = np.concatenate([segment.document(i) for i in range(segment.n_documents)])
    assert whole.tolist() == segment.ids.tolist()


@given(st.lists(st.integers(0, 10**12), max_size=700))
@settings(max_examples=40, deadline=None)
def test_elias_fano_round_trip(values):
    values = sorted(values)
    coded = EliasFano.from_bytes(EliasFano.of(np.array(values, np.int64)).to_bytes())
    assert coded.all().tolist() == values == [coded.select(i) for i in range(len(values))]


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000))
    assert 8 * len(EliasFano.of(ends).to_bytes()) < (2.5 + np.log2(ends[-1] / len(ends))) * len(ends)


ODD = st.text(st.sampled_from("aB éÉßİΣ.,'’!\n\t\r\x0b\x1c\xa0\u2003́日😀0½<|>"), max_size=40)


@given(st.lists(ODD | st.just("<|endoftext|>") | st.text(max_size=20), max_size=8))
@settings(max_examples=150, deadline=None)
def test_ids_and_counts_equal_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    column = pa.array(texts, pa.string())
    ids, offsets = tokens.encoder(definition("word_bpe_49k.json")).encode(column)
    library = brute.tokenizer("word_bpe_49k.json")
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
    counts = token_counts.counter(definition("byte_bpe_50k.json")).counts(column)
    library = brute.tokenizer("byte_bpe_50k.json")
    assert counts.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_counts(edges, edge_rows, empty):
    json = definition("byte_bpe_50k.json")
    assert rows(token_counts.token_counts(edges, json)) == ordered(brute.token_counts(edge_rows))
    assert rows(token_counts.token_counts(empty, json)) == []


def test_packing(edges, edge_rows, empty):
    found = packed(edges).collect()
    names = "doc_id", "piece", "start", "length", "ids_crc32"
    assert ordered(tuple(r[n] for n in names) for r in found) == ordered(brute.pieces(edge_rows))
    places = [(r["sequence_id"], r["offset"]) for r in found]
    assert len(set(places)) == len(places)
    assert packed(empty).count() == 0


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=12), st.integers(60, 70))
@settings(max_examples=60, deadline=None)
def test_packing_plan_places_every_piece_once(counts, capacity):
    used = {}
    for chosen, times in packing.plan(counts, capacity):
        assert times > 0 and sum(length * n for length, n in chosen.items()) <= capacity
        for length, n in chosen.items():
            used[length] = used.get(length, 0) + n * times
    assert used == counts


@given(st.lists(st.integers(1, 30), min_size=1, max_size=10), st.integers(30, 40))
@settings(max_examples=100, deadline=None)
def test_fullest_combination(lengths, capacity):
    counts = {length: lengths.count(length) for length in lengths}
    largest = max(lengths)
    sums = {largest}
    rest = list(lengths)
    rest.remove(largest)
    for length in rest:
        sums |= {s + length for s in sums if s + length <= capacity}
    chosen = packing.fullest(counts, sorted(counts, reverse=True), capacity)
    assert sum(length * n for length, n in chosen.items()) == max(sums)
    assert all(n <= counts[length] for length, n in chosen.items())


def test_decontamination(spark, edges, edge_rows, empty):
    items = [(1, "P10 p11 p12 p13, p14 p15 p16 p17 p18 p19 p20"), (2, "one TWO three"), (3, None), (4, "..."), (5, "b1"), (5, "two")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.scanned(edges, benchmark).select("row.doc_id", "n_words", "n_hit", "items")
    expected = [(i, n, h, k) for i, n, h, k, _, _ in brute.decontamination(edge_rows, items)]
    assert ordered((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in found.collect()) == ordered(expected)
    assert decontamination.scanned(empty, benchmark).count() == 0
    assert decontamination.scanned(edges, benchmark.where("false")).where("n_hit > 0").count() == 0
    clean = decontamination.decontaminated(edges, benchmark)
    assert clean.columns == edges.columns
    left = {r["doc_id"]: r for r in clean.collect()}
    assert 1 not in left and 13 not in left and {2, 3, 4, 5, 9, 10} <= set(left)
    assert left[9]["text"].split()[:10] == ["start", *(f"p{i}" for i in range(9))] and "p10" not in left[9]["text"]
    assert left[9]["n_chars"] == len(left[9]["text"]) and left[9]["text"].endswith("p69 end")


def test_decontamination_with_several_automata(spark, edges, edge_rows, monkeypatch):
    items = [(i, f"p{i} p{i + 1} p{i + 2}") for i in range(20)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontamination, "AUTOMATON_WORDS", 10)
    found = decontamination.scanned(edges, benchmark).select("row.doc_id", "n_words", "n_hit", "items")
    expected = [(i, n, h, k) for i, n, h, k, _, _ in brute.decontamination(edge_rows, items)]
    assert ordered((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in found.collect()) == ordered(expected)


def test_decontamination_bounds_its_groups(spark, edges, edge_rows, monkeypatch):
    """An item that repeats goes once, and no group is over the bound."""
    items = [(1, "p10 p11 p12")] * 40 + [(i, f"p{i} p{i + 1} p{i + 2}") for i in range(2, 8)]
    groups, scan = [], decontamination._scan
    monkeypatch.setattr(decontamination, "AUTOMATON_WORDS", 10)
    monkeypatch.setattr(decontamination, "_scan", lambda shared, *rest: groups.append(shared.value) or scan(shared, *rest))
    found = decontamination.scanned(edges, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(i for group in groups for i, _ in group) == [str(i) for i in range(1, 8)]
    assert all(sum(len(text.split()) for _, text in group) <= 10 for group in groups)
    expected = [(i, n, h, k) for i, n, h, k, _, _ in brute.decontamination(edge_rows, items)]
    rows_ = found.select("row.doc_id", "n_words", "n_hit", "items").collect()
    assert ordered((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in rows_) == ordered(expected)


def test_quality(edges, edge_rows, empty):
    names = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    found = quality.judged(edges).select("__row.doc_id", *names)
    assert rows(found) == ordered(brute.quality_base(edge_rows))
    assert quality.kept(edges).columns == edges.columns
    assert quality.judged(empty).count() == 0
    plan = quality.kept(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_quality_rules_by_kind(documents):
    prose = "the house of the old man is on the hill and it was built with stone that came from the valley"
    kinds = {
        1: prose,
        2: " ".join(f"{w}$$$" for w in prose.split()),
        3: " ".join(f"{w}!!" for w in prose.upper().split()),
        4: " | ".join(f"cell{i}" for i in range(30)),
        5: "\n".join([prose.replace("old", f"old{i}") for i in range(4)] + ["Home and more of it"] * 20),
        6: " ".join(f"{c}" for c in "abcdefghijklmnopqrstuvwxyz"),
    }
    kept = {r["doc_id"] for r in quality.kept(documents(list(kinds.items()))).collect()}
    assert kept == {1}


def test_stop_words_of_other_languages(spark):
    """The rule of four languages does not judge a fifth one; a document without a language is judged."""
    polish = "Stary dom stoi nad rzeką, a obok niego rośnie wysoki dąb, który pamięta jeszcze czasy naszych pradziadków i ich dzieci."
    rows_ = [(1, polish, "pl"), (2, polish, "en"), (3, polish, None), (4, polish, "PL-pl"), (5, polish, "de_AT"), (6, "a b", "pl")]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in quality.kept(docs, language="lang").collect()) == [1, 4]
    assert quality.kept(docs).count() == 0


def test_kept_measures_each_text_once(edges):
    """The filter on the verdict stays above the measures, so none is worked out twice."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(quality.kept(edges)).count("xxhash64") == plan(quality.judged(edges)).count("xxhash64") == 4


def test_tokenizers_of_another_kind_are_refused():
    assert tokens.ChunkEncoder(definition("word_bpe_49k.json"))
    with pytest.raises(ValueError, match="another kind"):
        tokens.ChunkEncoder(definition("byte_bpe_50k.json"))


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000, 5000])
def test_selects_of_runs(n):
    values = np.cumsum(np.random.default_rng(n).integers(0, 90, n))
    coded = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
    for start in {0, 1, 255, 256, 300, n // 2, n}:
        for end in {start, start + 1, start + 255, start + 600, n}:
            if start <= end <= n:
                assert coded.run(start, end).tolist() == values[start:end].tolist()
    with pytest.raises(IndexError):
        coded.run(n, n + 1)


def test_line_dedup(edges, edge_rows, empty):
    found = line_dedup.repeated(line_dedup.units(edges, min_words=4))
    assert rows(found.drop("text_hash")) == ordered(set(brute.repeated_lines(edge_rows, least=4)))
    clean = {(r["doc_id"], r["text"]) for r in line_dedup.deduplicated(edges, min_words=4).collect()}
    assert (15, "line of some words\n" + "\n" * 39) in clean and (6, "") in clean and (2, None) in clean and (9, edge_rows[11][1]) in clean
    assert line_dedup.deduplicated(empty).count() == 0 and line_dedup.passages(empty).count() == 0


def test_repeated_sentences(documents):
    """Sentences within lines; only those count that make a passage of repeated ones, and original offsets are kept."""
    shared = "One two three four! Five six seven? Eight nine ten eleven, twelve. "
    rows_ = [(1, f"Begin here. {shared}End."), (2, f"Other start {shared}Tail, 3.5 of it.\nFive six seven?  "), (3, f"Five six seven?\n{shared}")]
    rows_ += [(3, f"Five six seven?\n{shared}"), (None, shared), (6, "Five six seven? other"), (4, None), (5, "")]
    for run in (1, 4, 10):
        found = line_dedup.repeated(line_dedup.units(documents(rows_), sentences=True), run)
        assert rows(found.drop("text_hash")) == ordered(set(brute.repeated_lines(rows_, sentences=True, run=run)))
    named = [r for r in rows_ if r[0] is not None]
    texts = dict(named)
    assert all(texts[r["doc_id"]][r["start"] : r["end"]].split()[0] in ("One", "Five", "Eight") for r in found.collect())
    left = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(documents(named), sentences=True, min_run=5).collect()}
    assert left[1] == rows_[0][1] and left[2].split() == "Other start One two three four! Tail, 3.5 of it. Five six seven?".split()


def test_spans():
    assert spans.cut("0123456789", [(7, 9), (1, 3), (2, 5)]) == "0569"


def test_suffix_dedup(spark, documents, edges, edge_rows, empty):
    named = [(i, t) for i, t in dict(edge_rows).items() if i is not None]
    found = {}
    for r in suffix_dedup.repeated(documents(named)).collect():
        found.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["end_word"]))
    assert found == brute.repeated_words(named) and {6, 8, 10, 11} <= set(found)
    assert suffix_dedup.repeated(empty).count() == 0
    clean = suffix_dedup.deduplicated(edges)
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == edges.columns and 6 not in left and 11 not in left
    assert left[10].split() == ["other", "tail", "and", "more"] and left[9] == edge_rows[11][1] and left[2] is None and left[3] == ""


def test_runs_of_suffixes_over_the_edges_of_batches(spark):
    """Whatever the batches, a suffix is shared if its prefix stands in another text or place; hot prefixes fill many."""
    rnd = random.Random(4)
    rows_ = [(i, i % 7, 5 if i < 60 else rnd.randint(6, 40) if i < 150 else 100 + i, i % 3) for i in range(200)] + [(900 + i, 3, 77, 1) for i in range(30)]
    suffixes = spark.createDataFrame(rows_, "doc_id long, text_hash long, prefix long, place int")
    places = {}
    for _, text, prefix, place in rows_:
        places.setdefault(prefix, set()).add((text, place))
    expected = sorted((d, t, p, x) for d, t, p, x in rows_ if len(places[p]) > 1)
    for size in (1, 2, 3, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found = suffix_dedup._shared(suffixes).select("doc_id", "text_hash", "prefix", "place")
            assert sorted(map(tuple, found.collect())) == expected
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_suffix_dedup_finds_every_window(documents, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.randint(4, 30))] for _ in range(12)]
    docs = []
    for i in range(60):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 12))] for _ in range(rnd.randint(1, 12))]
        docs.append((i, " ".join(w for p in parts for w in p)))
    found = {}
    for r in suffix_dedup.repeated(documents(docs), length=12, spread=5).collect():
        found.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["end_word"]))
    assert found == brute.repeated_words(docs, length=12) and found


def test_components(spark):
    rnd = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(200, i) for i in range(201, 260)]
    links = [*chain, *star, *[(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(70)], (5, 5)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    parent = {x: x for pair in links for x in pair}
    for _ in links:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == {x: parent[x] for pair in links for x in pair if pair[0] != pair[1]}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_dedup(edges, edge_rows, empty):
    names = "doc_id", "n_shingles", "component_id", "kept"
    assert rows(near_dedup.components_of(edges, size=4), *names) == ordered(brute.near_duplicates(edge_rows))
    assert near_dedup.components_of(empty).count() == 0
    left = near_dedup.deduplicated(edges)
    assert left.columns == edges.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 7, 9, 12, 14, 15] and ids.count(None) == 2


def test_near_dedup_sends_no_table_uncounted(spark, documents, monkeypatch):
    """Spark expects exploded rows and compressed files to be small, and would send bands and shingles of any test through the driver."""
    plans = []

    def spy(df, name, kept=near_dedup.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(near_dedup, "stored", spy)
    monkeypatch.setattr(components, "stored", spy)
    monkeypatch.setattr(near_dedup, "SENT_ROWS", -1)
    base = [f"b{i}" for i in range(100)]
    near = [(i, " ".join([*base[:97], *(f"c{i}x{k}" for k in range(3))])) for i in range(6)]
    found = near_dedup.components_of(documents([*near, (9, "another text of a few words")]), size=4)
    assert rows(found, "doc_id", "component_id") == [*((i, 0) for i in range(6)), (9, 9)]
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("Join" in plan for plan in plans) > 5
    assert not [plan for plan in plans if "BroadcastHashJoin" in plan]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_dedup_loses_no_link(documents, seed):
    """Chains of near copies on both sides of the threshold, short texts, copies, and a passage that many texts share."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    docs, passage = [], [word() for _ in range(60)]
    for _ in range(8):
        text = [word() for _ in range(rnd.choice([3, 6, 12, 40, 120]))]
        for _ in range(12):
            docs.append(list(text))
            for _ in range(rnd.randint(0, 2)):
                text[rnd.randrange(len(text))] = word()
    docs += [[*passage, *(word() for _ in range(rnd.randint(5, 30)))] for _ in range(60)]
    docs += [docs[0]] * 30
    rnd.shuffle(docs)
    table = [(i, " ".join(d)) for i, d in enumerate(docs)]
    found = near_dedup.components_of(documents(table), size=4)
    assert rows(found, "doc_id", "n_shingles", "component_id", "kept") == brute.near_duplicates(table)


def test_registers_estimate_similarity():
    rng = np.random.default_rng(3)
    for size in (1, 3, 20, 500, 20_000):
        for share in (0.5, 0.8, 1.0):
            both = rng.integers(0, 2**64, max(1, int(2 * size * share / (1 + share))), np.uint64)
            a, b = (np.unique(np.r_[both, rng.integers(0, 2**64, max(0, size - len(both)), np.uint64)]) for _ in range(2))
            shared = len(np.intersect1d(a, b))
            real = shared / (len(a) + len(b) - shared)
            coded = near_dedup.registers([a, b])
            found = near_dedup.estimate((coded[0] == coded[1]).sum(keepdims=True), np.array([len(a)]), np.array([len(b)]))[0]
            assert abs(found - real) < 0.2


def test_patience_alignment():
    assert license_scan.align(list("abcdef"), list("xabydezf")) == [(0, 1), (1, 2), (3, 4), (4, 5), (5, 7)]
    assert license_scan.align([], [1]) == [] == license_scan.align([1], [2])
    assert license_scan._rising([(0, 5), (1, 1), (2, 2), (3, 9), (4, 3)]) == [(1, 1), (2, 2), (4, 3)]


def test_license_scan(documents, edges, empty):
    mit = license_scan.TEMPLATES["MIT"][0]
    changed = mit.replace("hereby granted", "granted").replace("sublicense,", "").replace("persons", "people")
    texts = [
        (1, f"x {mit} y Released under the MIT License. z"),
        (2, f"code\n# {changed}"),
        (3, mit[: len(mit) // 2]),
        (4, "Released under the BSD License. Licensed and permitted software, gnu apache mit"),
        (5, "RELEASED   under the\nMIT license " * 3),
        (6, " ".join(license_scan.TEMPLATES[name][0] for name in license_scan.TEMPLATES)),
    ]
    found = {}
    for r in license_scan.scan(documents(texts)).collect():
        found.setdefault(r["doc_id"], []).append((r["start"], r["license"]))
        assert r["coverage"] >= 0.8
    names = {i: [name for _, name in sorted(own)] for i, own in found.items()}
    assert names[1] == ["MIT", "MIT-notice"] and names[2] == ["MIT"] and names[5] == ["MIT-notice"] * 3
    assert 3 not in names and 4 not in names
    assert {"MIT", "ISC", "BSD-2-Clause", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0-notice", "GPL-3.0-notice"} <= set(names[6])
    assert license_scan.scan(edges).count() == 0 == license_scan.scan(empty).count()


def licenses_in(text, reserved=False):
    return [found[0] for found in license_scan.found_in(decontamination.folded(text), reserved)]


def test_every_license_text_is_found_as_itself():
    for name, text, _, _ in license_scan.entries(reserved=True):
        assert licenses_in(f"some words {text} more words", reserved=True) == [name]


def test_licenses_that_look_alike():
    gnu = "This work is licensed under the GNU {} License, version {}."
    assert licenses_in(gnu.format("Lesser General Public", 3)) == ["LGPL-3.0-notice"]
    assert licenses_in(gnu.format("Affero General Public", 3)) == ["AGPL-3.0-notice"]
    assert licenses_in(gnu.format("General Public", 2)) == ["GPL-2.0-notice"]
    assert licenses_in(gnu.format("Free Documentation", "1.3")) == []
    assert licenses_in("Licensed under the GNU Lesser General Public License, version 2.1") == ["LGPL-2.1-notice"]
    assert licenses_in("Licensed under CC BY-NC-SA 4.0.") == ["CC-BY-NC-SA-4.0-notice"]
    assert licenses_in("Licensed under CC BY-NC 3.0.") == ["CC-BY-NC-3.0-notice"]
    assert licenses_in("Licensed under CC BY 4.0.") == ["CC-BY-4.0-notice"]
    assert licenses_in("Licensed under the Apache License, Version 1.0.") == []
    agpl = license_templates.WHOLE["GPL-3.0"][0].replace("convey", "convey remotely", 1)
    assert "GPL-3.0" not in licenses_in(agpl.split("How to Apply")[0])


def test_reserved_rights(documents):
    texts = [(1, "Text.\nAll rights reserved."), (2, "Tous droits réservés"), (3, "Released under the MIT License."), (4, "rights")]
    found = sorted((r["doc_id"], r["license"]) for r in license_scan.scan(documents(texts), reserved=True).collect())
    assert found == [(1, "all-rights-reserved"), (2, "all-rights-reserved"), (3, "MIT-notice")]
    assert [r["doc_id"] for r in license_scan.scan(documents(texts)).collect()] == [3]


def test_url_parts_and_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Org?x", "x://Sub.Example.ORG/en/12?q#f", "http://example.org/en/2",
        "http://example.org", "http://evilexample.org/es/", "https://a.com/fr/x://y", "http://b.com/de/", "http://b.com#/de/", "http://b.com/DE/",
    ]
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls)], "page_id long, url string, host string, row string")
    model = url_filter.UrlModel(None, spark.createDataFrame([], "suffix string, suffix_rows double, suffix_rate double"), 0.0)
    found = {r["page_id"]: tuple(r)[2:6] for r in url_filter.judged(pages, URL_RULES, model).collect()}
    blank = ("", "", None, "allow")
    assert [found[i] for i in range(13)] == [
        blank, blank, blank, blank, ("a.org", "", None, "allow"), ("sub.example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"), ("example.org", "", None, "allow"), ("evilexample.org", "/es/", "org/", "allow"),
        ("a.com", "/fr/x://y", "com/fr/", "allow"), ("b.com", "/de/", "com/de/", "block"), ("b.com", "", None, "allow"), ("b.com", "/DE/", None, "allow"),
    ]


def test_labels_by_whole_words_and_by_hosts(spark):
    hosts = ["soundtrack.org", "alphabets.com", "adulteducation.net", "heads-up.org", "free-bets.com", "x.casino.net", "", None, "a.shop.example", "ok.a.shop.example"]
    urls = spark.createDataFrame([(i, h) for i, h in enumerate(hosts)], "page_id long, host string")
    labels = lambda df: [r["label"] for r in df.orderBy("page_id").collect()]
    assert labels(url_filter.labelled(urls)) == [0, 0, 0, 0, 1, 1, 0, 0, 0, 0]
    given = [("Shop.example", 1), ("ok.a.shop.example", 0), ("casino.net", 0), ("casino.net", 0)]
    found = url_filter.labelled(urls, spark.createDataFrame(given, "host string, label int"))
    assert found.columns == ["page_id", "host", "label"] and labels(found) == [0, 0, 0, 0, 1, 0, 0, 0, 1, 0]


def test_url_model_on_held_out_urls(spark):
    """The trees learn the labels of the sample and carry over to urls that were not in it."""
    pages = url_filter.with_parts(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"))
    labelled = pages.withColumn("label", url_filter.seed_label(F.col("host")))
    held_out = F.pmod(F.xxhash64("url"), F.lit(4)) == 0
    model = url_filter.fit(labelled.where(~held_out))
    scored = model.score(labelled.where(held_out)).select("label", (F.col("probability") >= 0.5).cast("double").alias("found"))
    hits = {(r["label"], r["found"]): r["n"] for r in scored.groupBy("label", "found").agg(F.count("*").alias("n")).collect()}
    assert hits.get((1.0, 1.0), 0) >= 0.9 * sum(n for (label, _), n in hits.items() if label == 1)
    assert hits.get((0.0, 0.0), 0) >= 0.95 * sum(n for (label, _), n in hits.items() if label == 0)
    assert url_filter.fit(labelled.where("false")).constant == 0.0
    assert url_filter.fit(labelled.where("label = 1")).constant == 1.0


def test_url_model_counts_every_url(spark):
    """Neither the suffix statistics nor the intervals nor the trees leave out urls, however many of a label there are."""
    ids = spark.range(24_000).select(
        F.concat(F.lit("http://h."), F.when(F.col("id") < 12_000, "aa").otherwise("bb"), F.lit("/"), F.lpad("id", 5, "0")).alias("url"),
        (F.col("id") % 2).cast("double").alias("label"),
    )
    model = url_filter.fit(ids.withColumns({"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))}), trees=1, depth=1)
    found = {r["suffix"]: r["suffix_rows"] for r in model.suffixes.collect()}
    assert found == {"aa": round(math.log1p(12_000), 2), "bb": round(math.log1p(12_000), 2)}
    # Every feature is nominal: MLlib looks for the splits of continuous ones in a sample.
    rows = url_filter.features(ids.withColumns({"host": F.lit("h.aa"), "path": F.lit("/"), "suffix_rows": F.lit(1.0), "suffix_rate": F.lit(0.5)}))
    attributes = model._assembled(rows).schema["features"].metadata["ml_attr"]["attrs"]
    assert set(attributes) == {"nominal"} and len(attributes["nominal"]) == len(url_filter.FEATURES)


def test_words():
    texts = pa.array(["a  b\tc", None, "", " x\n", "a\x1cb\xa0c"])
    codes, offsets, distinct = words.split(texts)
    assert [[distinct[c].as_py() for c in codes[a:b]] for a, b in zip(offsets, offsets[1:])] == [["a", "b", "c"], [], [], ["x"], ["a\x1cb\xa0c"]]
    h = np.arange(1, 30, dtype=np.uint64)
    runs = words.run_hashes(np.r_[h, h], 5)
    assert len(runs) == 54 and (runs[:25] == runs[29:]).all() and len(set(runs.tolist())) == 29
    batch = pa.record_batch([pa.array(["xx", None, "y" * 9, "", "z"])], ["text"])
    assert [b.num_rows for b in words.slices([batch], slice_bytes=4)] == [3, 2]


def test_pipeline_stages(spark, documents):
    """Each stage against its brute-force version on what the one before kept."""
    import duckdb

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name == "packing":
            break
        assert out.dtypes == docs.dtypes
        before, held = held, {r["doc_id"]: r["text"] for r in out.collect()}
        assert out.where("n_chars != length(text)").count() == 0
        if name == "quality_rules":
            assert all(held[i] == before[i] for i in held)
            assert not {r[0] for r in brute.quality_base(list(before.items())) if r[-1]} & set(held)
        if name == "near_dedup":
            assert set(held) == {r[0] for r in brute.near_duplicates(list(before.items()), size=5) if r[3]}
        if name == "suffix_dedup":
            gone = brute.repeated_words(list(before.items()))
            for i, text in before.items():
                assert held.get(i, "").split() == [w for j, w in enumerate(text.split()) if j not in gone.get(i, ())]
        if name == "decontamination":
            rows_ = brute.decontamination(list(before.items()), items)
            assert set(held) == {r[0] for r in rows_ if 2 * r[2] <= r[1]}
            assert all(held[r[0]] == before[r[0]] for r in rows_ if not r[2])
            assert not any(r[2] for r in brute.decontamination(list(held.items()), items) if not dict((x[0], x[2]) for x in rows_)[r[0]])
        docs = documents([(i, t) for i, t in held.items()], clashing=False)
    names = "doc_id", "piece", "start", "length", "ids_crc32"
    assert rows(out, *names) == sorted(brute.pieces(list(held.items())))
