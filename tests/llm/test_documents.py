"""Operators on documents against plain-Python versions of their contracts, edge cases included."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import edge_texts, prose
from pyspark.sql import functions as F

from brisa.llm import decontamination, jaccard, packing, quality_rules, rule_ensemble, secrets, substrings, token_files
from brisa.llm.tokens import PieceEncoder, tokenizer_path

WORD = re.compile("[^\x20\x09-\x0d]+")
key = lambda row: tuple((v is not None, v if v is not None else 0) for v in row)


def same(df, expected):
    assert sorted([tuple(r) for r in df.collect()], key=key) == sorted(expected, key=key)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- n-gram Jaccard join -------------------------------------------------------------------------


def shingles(text):
    words = WORD.findall(lower(text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def grouped(texts):
    sets = [shingles(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(texts):
        if doc is not None:
            ids[find(i)].append(doc)
    return [(doc, len(sets[i]), min(ids[find(i)], default=None)) for i, (doc, _) in enumerate(texts)]


def test_jaccard_edges(edge, empty):
    same(jaccard.jaccard_groups(edge), grouped(edge_texts()))
    assert jaccard.jaccard_groups(empty).count() == 0


def test_jaccard_family_of_changed_copies(spark):
    """Copies that link to their source only, to each other only, and to nobody, with frequent shared lines."""
    source = prose(50, 146).split(" ")
    line = prose(51, 14)
    texts = []
    for i in range(150):
        words = list(source)
        for j in range(i % 8):
            words[(17 * j + 3 * i) % 146] = f"new{i}x{j}"
        texts.append((i, " ".join(words) + ("\n" + line if i % 3 == 0 else "")))
    texts += [(1000 + i, line + "\n" + prose(100 + i, 6 + i % 30)) for i in range(100)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    same(jaccard.jaccard_groups(docs), grouped(texts))


def test_jaccard_stage_keeps_one_of_each(edge, empty):
    kept = jaccard.one_of_each(edge)
    assert kept.columns == edge.columns
    got = sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=key)
    expected = [t for t, (doc, size, group) in zip(edge_texts(), grouped(edge_texts())) if size == 0 or doc == group]
    expected.remove((12, "same " * 200))
    assert got == sorted(expected, key=key)
    assert jaccard.one_of_each(empty).count() == 0


# --- substring de-duplication -----------------------------------------------------------------


def without_repeats(texts, window=35):
    words = [WORD.findall(t or "") for _, t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(texts, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("limit", [substrings.GROUP_LIMIT, 1])
def test_substrings(edge, limit):
    same(substrings.remove_repeats(edge, group_limit=limit), without_repeats(edge_texts()))


def test_substrings_of_many_changed_copies(spark, empty):
    source = prose(60, 300).split(" ")
    texts = [(i, " ".join(source[i % 50 : 260 + i % 40] + [f"end{i % 4}"] + source[: i % 37])) for i in range(60)] + [(99, "a b c " * 60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    for limit in (substrings.GROUP_LIMIT, 8):
        same(substrings.remove_repeats(docs, group_limit=limit), without_repeats(texts))
    assert substrings.remove_repeats(empty).count() == 0


# --- benchmark decontamination ----------------------------------------------------------------

ITEM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contaminated(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        if item is not None:
            w = ITEM.findall(lower(text or ""))
            for i in range(max(1, len(w) - 12) if w else 0):
                windows[tuple(w[i : i + 13])].add(str(item))
    out = []
    for doc, text in texts:
        w = ITEM.findall(lower(text or ""))
        hit, found = set(), set()
        for size in {len(p) for p in windows}:
            for i in range(len(w) - size + 1):
                if (part := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[part]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("slice_bytes", [decontamination.SLICE_BYTES, 60])
def test_decontamination(spark, edge, empty, slice_bytes):
    items = [(1, prose(2, 50)), (1, prose(2, 50)), (2, prose(1, 120)), (3, "One-TWO!"), (4, "three"), (5, None), (6, " ... "), (None, "same"), (10, prose(1, 40)), (7, "same same same")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, starts string")
    same(decontamination.contamination(edge, benchmark, slice_bytes=slice_bytes), contaminated(edge_texts(), items))
    kept = decontamination.clean(edge, benchmark, slice_bytes=slice_bytes)
    clean = [t for t, r in zip(edge_texts(), contaminated(edge_texts(), items)) if not r[-1]]
    assert kept.columns == edge.columns
    same(kept.select("doc_id", "text"), clean)
    assert decontamination.contamination(empty, benchmark, slice_bytes=slice_bytes).count() == 0
    assert decontamination.contamination(edge, benchmark.limit(0)).where("n_hit > 0 or contaminated").count() == 0


def test_decontamination_tables_follow_the_benchmark(spark):
    """Tables of a slice stay within a hundred megabytes for eight of text, and many slices find what one finds."""
    rng = np.random.default_rng(8)
    vocabulary = [prose(i, 1) + str(i) for i in range(3000)]
    items = [(str(i), " ".join(vocabulary[j] for j in rng.integers(0, 3000, 400))) for i in range(3000)]
    size = sum(len(t) for _, t in items)
    tables = decontamination.Searches(items, decontamination.WINDOW)
    assert size > 8_000_000 and tables.bytes < 100 * size / 8
    docs, expected = [], []
    for i in range(200):
        words = items[i][1].split(" ")
        lead = [vocabulary[j] + "x" for j in rng.integers(0, 3000, 20 + i)]
        docs.append((i, " ".join([*lead, *words[i : i + 12 + i % 4], *lead])))
        hit = 12 + i % 4 if i % 4 else 0
        expected.append((i, 2 * len(lead) + 12 + i % 4, hit, int(hit > 0), 20 * hit >= 2 * len(lead) + 12 + i % 4 and hit > 0))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    found = decontamination.contamination(frame, benchmark, slice_bytes=size // 3)
    same(found.select("doc_id", "n_words", "n_hit", "n_items", "contaminated"), expected)


# --- quality rules and classifier -------------------------------------------------------------


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    repeats = len(covered)
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeats, failed


LABELS = "doc_id long, quality int, toxic int, text string"


def test_quality_base_counts(spark, edge, empty):
    labels = spark.createDataFrame([(None, 1, 0, "x"), (1, None, 0, "x"), (2, 7, 0, "x")], LABELS)
    got = quality_rules.quality(edge, labels)
    expected = [(doc, *base_counts(t), not base_counts(t)[-1]) for doc, t in edge_texts()]
    same(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"), expected)
    kept = quality_rules.kept_documents(edge, labels)
    assert kept.columns == edge.columns and kept.count() == sum(e[-1] for e in expected)
    assert quality_rules.quality(empty, labels).count() == 0
    assert rule_ensemble.classify(edge, labels).where("score = 0.5").count() == len(expected)
    assert rule_ensemble.classify(empty, labels).count() == 0


def labelled(spark):
    good = [(i, prose(i, 80 + i % 50), 1) for i in range(200)]
    bad = [(1000 + i, " | ".join(prose(5000 + i, 70).split(" ")) if i % 2 else prose(5000 + i, 70).replace(" ", "!! ").upper(), 0) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in good + bad], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, q, 0, "x") for i, _, q in good + bad for _ in range(2)] + [(0, 0, 0, "x")], LABELS)
    return docs, labels


def test_quality_models_tell_junk(spark):
    docs, labels = labelled(spark)
    truth = F.col("doc_id") < 1000
    judged = quality_rules.quality(docs, labels)
    assert judged.where(F.col("kept") != truth).count() <= 3
    assert judged.where("probability < 0 or probability > 1").count() == 0
    scored = rule_ensemble.classify(docs, labels)
    held = scored.where("held_out").withColumn("right", (F.col("predicted") == 1) == truth)
    assert held.count() > 30 and held.where("not right").count() <= 2
    fold = [zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in scored.select("doc_id").collect()]
    assert fold == [r["held_out"] for r in scored.select("held_out").collect()]
    again = {r["doc_id"]: r["score"] for r in rule_ensemble.classify(docs.repartition(7), labels).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in scored.collect())


def test_a_repeated_id_is_one_row_of_the_quality_model(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows = [(i, " ".join(words[(i * k + k) % (3 if i % 2 else 6)] for k in range(1, 40))) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    whole = quality_rules.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels, log_size=12)
    again = quality_rules.fit(spark.createDataFrame(rows + [rows[7]] * 400, "doc_id long, text string").repartition(5), labels, log_size=12)
    assert (whole.weights == again.weights).all() and (whole.bias, whole.slope, whole.shift) == (again.bias, again.slope, again.shift)
    # Of many texts under one id there is one.
    sizes = []
    many = spark.createDataFrame(rows + [(7, f"text {n} of the hot one") for n in range(400)], "doc_id long, text string").repartition(5)
    descend = quality_rules._descend
    quality_rules._descend = lambda x, y, *rest: sizes.append(len(y)) or descend(x, y, *rest)
    try:
        quality_rules.fit(many, labels, log_size=12)
    finally:
        quality_rules._descend = descend
    assert 0 < sizes[0] <= 60


def test_rules_of_a_printed_tree():
    printed = "If (feature 0 <= 1.5)\n If (feature 1 <= 2.0)\n  Predict: 0.0\n Else (feature 1 > 2.0)\n  Predict: 1.0\nElse (feature 0 > 1.5)\n Predict: 1.0\n"
    printed = "DecisionTree...\n" + "\n".join("  " + line for line in printed.splitlines())
    rules = {rule.parts for rule in rule_ensemble.paths(printed, ["a", "b"])}
    assert rules == {(("a", True, 1.5),), (("a", False, 1.5),), (("a", True, 1.5), ("b", True, 2.0)), (("a", True, 1.5), ("b", False, 2.0))}


# --- tokens ----------------------------------------------------------------------------------

BYTE, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
TRICKY = [t or "" for _, t in edge_texts()] + [
    "it's we'll I'd 'tis  double\n\nline tail\n", "<|endoftext|> a <|startoftext|>", "naïve Éé İı ǅ ſt ß ẞ Ωσς", "á e ́x", "1234 12a b3 $5.00, (x) [y]", "don't,won't", "tab\there", "a\r\nb", " lead", "trail ",
]


@pytest.mark.parametrize("name", [BYTE, WORDS])
def test_pieces_encode_like_whole_texts(name):
    encoder = PieceEncoder(tokenizer_path(name))
    assert [list(np.frombuffer(ids, "<u4")) for ids in encoder.encode(TRICKY * 2)] == [e.ids for e in encoder.tokenizer.encode_batch(TRICKY * 2, add_special_tokens=False)]


@pytest.mark.parametrize("name", [BYTE, WORDS])
def test_pieces_encode_like_whole_documents(spark, name):
    encoder = PieceEncoder(tokenizer_path(name))
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    assert encoder.encode(texts) == encoder.whole(texts)


def ids_of(name, text, end):
    encoder = PieceEncoder(tokenizer_path(name))
    return encoder.whole([text or ""])[0] + np.array([end], "<u4").tobytes()


def test_differencing_fills_evenly():
    sizes = [(37 * i) % 256 + 1 for i in range(600)]
    parts = packing.differencing(sizes, 75)
    assert sorted(i for p in parts for i in p) == list(range(600))
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert max(sums) - min(sums) <= 2
    assert packing.differencing([5], 3) == [[0], [], []] and packing.differencing([], 2) == [[], []]
    assert [sorted(p) for p in packing.pack_group([3, 3, 3], 5)] == [[0], [1], [2]] or len(packing.pack_group([3, 3, 3], 5)) == 3


@pytest.mark.parametrize("group", [packing.GROUP, 2])
def test_packing_holds_each_id_once(edge, empty, group):
    rows = packing.pack(edge, tokenizer_path(BYTE), group=group).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] > 0
        by_doc[(r["doc_id"], r["doc_tokens"])].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    expected = Counter((doc, ids_of(BYTE, t, 0)) for doc, t in edge_texts())
    for (doc, total), held in by_doc.items():
        held = sorted(held, key=lambda r: r["start"])
        texts = [ids for (d, ids) in expected.elements() if d == doc and len(ids) == 4 * total]
        assert sum(r["length"] for r in held) == total * len(texts)
        for r in held:
            assert any(bytes(r["ids"]) == ids[4 * r["start"] : 4 * (r["start"] + r["length"])] for ids in texts)
    assert sum(r["length"] for r in rows) == sum(len(ids) // 4 for _, ids in expected.elements())
    sums = packing.digest(packing.pack(edge, tokenizer_path(BYTE), group=group)).collect()
    assert sorted(r["ids_crc32"] for r in sums) == sorted(zlib.crc32(r["ids"]) for r in rows)
    assert packing.pack(empty, tokenizer_path(BYTE)).count() == 0


def test_packing_pads_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    packed = packing.pack(docs, tokenizer_path(BYTE)).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    row = packed.agg(F.sum("n").alias("used"), F.count("*").alias("n")).first()
    assert row["used"] >= 0.97 * 1024 * row["n"]


def test_token_files_round_trip(spark, edge, empty, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(edge, path, tokenizer_path(WORDS))
    back = token_files.read_tokens(spark, path)
    rows = back.collect()
    by_start = sorted(rows, key=lambda r: r["start"])
    order = [r["doc_id"] for r in by_start]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    at = 0
    for r in by_start:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    assert Counter((r["doc_id"], np.array(r["ids"], "<u4").tobytes()) for r in rows) == Counter((d, ids_of(WORDS, t, 1)) for d, t in edge_texts())
    crc = {(r["start"], r["ids_crc32"]) for r in token_files.with_crc(back).collect()}
    assert crc == {(r["start"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in rows}
    plan = back.where("doc_id = 11")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,11)" in plan
    none = str(tmp_path / "none")
    token_files.write_tokens(empty, none, tokenizer_path(WORDS))
    assert token_files.read_tokens(spark, none).count() == 0


def test_token_files_have_indexes_and_are_read_by_stripe(spark, tmp_path):
    """Integer run lengths, row indexes and a Bloom filter on ids alone; stripes of one file are read by different tasks."""
    path, hadoop = str(tmp_path / "tokens"), spark.sparkContext._jsc.hadoopConfiguration()
    docs = spark.createDataFrame([(3 * i, f"document {i} of many words {i * i}") for i in range(60_000)], "doc_id long, text string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions")}
    hadoop.set("orc.stripe.size", "40000")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        token_files.write_tokens(docs, path, tokenizer_path(WORDS))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        [file] = spark.read.orc(path).inputFiles()
        orc, at = spark._jvm.org.apache.orc.OrcFile, spark._jvm.org.apache.hadoop.fs.Path(file)
        reader = orc.createReader(at, orc.readerOptions(hadoop))
        stripes = list(reader.getStripes())
        assert len(stripes) > 2 and reader.getRowIndexStride() > 0
        rows = reader.rows()
        for stripe in stripes:
            footer = rows.readStripeFooter(stripe)
            streams = [(x.getKind().toString(), x.getColumn()) for x in footer.getStreamsList()]
            assert [c for kind, c in streams if kind.startswith("BLOOM_FILTER")] == [1]  # doc_id
            assert {c for kind, c in streams if kind == "ROW_INDEX"} == set(range(6))
            assert {c.getKind().toString() for c in list(footer.getColumnsList())[1:]} == {"DIRECT_V2"}
        back = token_files.read_tokens(spark, path)
        assert spark.read.orc(path).rdd.getNumPartitions() > 2
        assert back.count() == 60_000 and back.where("doc_id = 300").first()["n_tokens"] == len(back.where("doc_id = 300").first()["ids"])
        assert back.where("doc_id = 301").count() == 0
    finally:
        hadoop.unset("orc.stripe.size")
        for k, v in old.items():
            spark.conf.set(k, v)


# --- secrets ---------------------------------------------------------------------------------


def test_secrets_of_all_rows(edge, empty):
    got = secrets.secrets(edge).collect()
    assert len(got) == len(edge_texts()) and all(r["complete"] and r["spans"] == "" and r["n_hex"] == 0 for r in got)
    assert secrets.secrets(empty).count() == 0
    same(secrets.redact(edge).select("doc_id", "text", "n_chars"), [(d, t, None if t is None else len(t)) for d, t in edge_texts()])
