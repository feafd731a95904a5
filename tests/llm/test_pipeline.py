"""Each stage of the pipeline, and its result, against plain-Python versions on planted documents."""

import base64
import random
import zlib

import numpy as np
from conftest_llm import prose
from test_documents import BYTE, base_counts, contaminated, grouped, ids_of

import corpus_pipeline

SECRET = "password = 'hunter2hunter2hunter2'"


def planted():
    """Rows ``(doc_id, text, kept, quality)``: whether the rules are to keep it and its label, if any."""
    passage = prose(900, 60)
    rows = [(i, prose(i, 120 + i % 50), True, 1 if i < 80 else None) for i in range(100)]
    junk = lambda i: " | ".join(prose(5000 + i, 90).split(" ")) if i % 2 else prose(5000 + i, 90).replace(" ", "!! ").upper()
    rows += [(1000 + i, junk(i), False, 0 if i < 60 else None) for i in range(80)]
    rows += [(1500, prose(1500, 20), False, None), (1501, "same " * 90, False, None)]
    for i in range(6):  # near copies, and one with too many changes
        words = rows[i][1].split(" ")
        words[50] = "changed"
        rows.append((2000 + i, " ".join(words), True, None))
    words = rows[7][1].split(" ")
    rows.append((2100, " ".join("ba" + w if n % 12 == 0 else w for n, w in enumerate(words)), True, None))
    rows += [(3000, f"{prose(31, 60)} {passage} {prose(32, 60)}", True, None), (3001, prose(33, 300) + " " + " ".join(passage.split(" ")[:13]) + " " + prose(34, 200), True, None)]
    hidden = [SECRET, base64.b64encode(SECRET.encode()).decode(), base64.urlsafe_b64encode(b"config says ok~~~?? " + SECRET.encode()).decode(), base64.b64encode(zlib.compress(SECRET.encode())).decode()]
    hidden.append("".join(f"%{b:02X}" for b in SECRET.encode()))
    rows += [(4000 + i, f"{prose(40 + i, 300)} {packed} {prose(50 + i, 300)}", True, None) for i, packed in enumerate(hidden)]
    return rows, passage, {4000 + i: packed for i, packed in enumerate(hidden)}


def test_every_stage_by_brute_force(spark, tmp_path):
    rows, passage, hidden = planted()
    random.Random(3).shuffle(rows)
    sf = str(tmp_path)
    docs = spark.createDataFrame([(i, t, "x", len(t)) for i, t, _, _ in rows], "doc_id long, text string, source string, n_chars int").repartition(5)
    docs.write.parquet(f"{sf}/documents.parquet")
    # Labels without an id or a quality, of unknown documents, repeated, and both ways: none of them changes what the rules learn.
    odd = [(None, 1, 0), (None, None, None), (90, None, 0), (91, 7, 0), (92, 0, 0), (92, 1, 0), (10**9, 0, 1), (1, 1, 0), (1, 1, 1)]
    labels = odd + [(i, q, 0) for i, _, _, q in rows if q is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    expected = [(i, t) for i, t, good, _ in rows if good and not base_counts(t)[-1]]
    stages = [expected]
    stages.append([t for t, (doc, _, group) in zip(expected, grouped(expected)) if doc == group])
    stages.append([t for t, found in zip(stages[-1], contaminated(stages[-1], [(1, passage)])) if not found[-1]])
    # 'password = ' and its value, without the last quote, is the match; what is encoded goes as a whole.
    redacted = {i: SECRET.removesuffix("'") if packed == SECRET else packed.rstrip("=") for i, packed in hidden.items()}
    gone = {i for i, _ in expected} - {i for i, _ in stages[-1]}
    assert {2000, 3000} <= gone and not {2100, 3001, *hidden} & gone

    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf).write.parquet(f"{sf}/stage-{number}")
        docs = spark.read.parquet(f"{sf}/stage-{number}")
        got = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        if number < 3:
            assert got == sorted(stages[number]), number
    final = dict(got)
    assert final.keys() == dict(stages[-1]).keys()
    for i, t in stages[-1]:
        if i in hidden:
            before, after = t.split(hidden[i])
            middle = final[i].removeprefix(before).removesuffix(after)
            assert final[i].startswith(before) and final[i].endswith(after) and middle.strip("='%27") == "[SECRET]", (i, middle)
            assert "hunter2" not in middle and redacted[i] not in final[i]
        else:
            assert final[i] == t, i

    # The whole run: every piece's checksum is that of its part of the document's ids.
    held = {}
    for r in corpus_pipeline.run(spark, sf).collect():
        held.setdefault(r["doc_id"], []).append(r)
    assert held.keys() == final.keys()
    for i, pieces in held.items():
        ids, at = np.frombuffer(ids_of(BYTE, final[i], 0), "<u4"), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids), i
            at += r["length"]
        assert at == len(ids)
