"""Licence cosines, the rule ensemble and the n-gram classifier, each recomputed in plain Python, one text at a time."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import edge_texts, prose

from brisa.llm import batches, licenses, quality_rules, rule_ensemble

# --- licence scan ---------------------------------------------------------------------------------


def cosine(a, b, idf):
    dot = sum(n * b[t] * idf(t) ** 2 for t, n in a.items() if t in b)
    norms = [math.sqrt(sum((n * idf(t)) ** 2 for t, n in c.items())) for c in (a, b)]
    return dot / (norms[0] * norms[1]) if all(norms) else 0.0


def own_license(text, idf, short, wholes):
    """(licence, score, is_file): the nearest notice of any header, then what the text is as a whole."""
    best = (0.0, None)
    if not licenses.signed(text):
        return None, None, False
    near = lambda words, given, least: max(
        [(round(cosine(words, t, idf), 12), -place, name) for place, ((name, t), low) in enumerate(zip(given, least)) if cosine(words, t, idf) >= low], default=None
    )
    for header in licenses.headers(text):
        found = near(licenses.terms(header), short, [licenses.HEADER] * len(short))
        if found and found[0] > best[0]:
            best = found[0], found[2]
    words, is_file = licenses.terms(text), False
    opening = near(words, short, [licenses.FILE] * len(short))
    if opening:
        is_file = True
        best = (opening[0], opening[2]) if opening[0] > best[0] else best
    whole = near(words, wholes, [licenses.WHOLE_SHORT if sum(t.values()) < 2 * licenses.SHORT_WORDS else licenses.WHOLE for _, t in wholes])
    if whole:
        is_file, best = True, (whole[0], whole[2])
    return best[1], best[0] if best[1] else None, is_file


def scanned(files):
    texts = [t or "" for _, _, t in files]
    counts = [set(licenses.terms(t)) for t in texts]
    templates, wholes = licenses.templates(), licenses.whole_texts()
    known = {t for _, c in templates + wholes for t in c}
    frequency = Counter(t for c in counts for t in c & known)
    idf = lambda t: (math.log((1 + len(texts)) / (1 + frequency[t])) if t in known else math.log(1 + len(texts))) + 1
    own = [own_license(t, idf, templates, wholes) for t in texts]
    folders = {}
    for (_, path, _), (name, score, is_file) in zip(files, own):
        if is_file and path is not None:
            folders.setdefault(path.rpartition("/")[0], []).append((-round(score, 9), name))
    out = []
    for (doc, path, _), (name, score, is_file) in zip(files, own):
        inherited = above = None
        at = None if path is None else path.rpartition("/")[0]
        while at is not None:
            if at in folders:
                inherited, above = min(folders[at])[1], at
                break
            at = at.rpartition("/")[0] if at else None
        out.append((doc, path, name, None if score is None else round(score, 9), is_file, inherited, above, name or inherited))
    return out


def test_licenses_equal_brute_force(spark):
    mit, isc, bsd = (licenses.TEXTS[n] for n in ("MIT", "ISC", "BSD-3-Clause"))
    notice = licenses.NOTICES["Apache-2.0"][0]
    files = [
        ("a/LICENSE", mit), ("a/COPYING", mit), ("a/b/LICENSE", isc), ("a/b/c.py", prose(1, 30)), ("a/b/d/e/f.py", prose(2, 30)),
        # Two licences of a directory: the nearer one counts; the same twice, and repeated rows, change nothing.
        ("t/LICENSE-1", isc), ("t/LICENSE-2", mit), ("t/x.py", "code"), ("t/LICENSE-1", isc), ("t/x.py", "code"),
        ("u/LICENSE", mit + "\n" + prose(3, 20)), ("u/v.py", f"# {notice}\n# and no more\n{prose(4, 50)}"),
        ("u/long.txt", f"{prose(5, 60_000)}\n{notice}\n{prose(6, 60_000)}"), ("u/both.txt", f"// {notice}\n\n// Released under the MIT License\n"),
        ("root.py", prose(7, 10)), ("LICENSE", bsd), (None, notice), (None, None), ("w/none.py", None), ("w/empty.py", ""),
        ("w/near.py", "This text speaks of a license and of copyright but grants nothing to anyone at all."),
    ]
    rows = [(i, p, t) for i, (p, t) in enumerate(files)]
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string").repartition(4)
    found = [
        (r["doc_id"], r["path"], r["license"], None if r["score"] is None else round(r["score"], 9), r["is_file"], r["inherited"], r["inherited_from"], r["effective"])
        for r in licenses.scan(frame).collect()
    ]
    assert sorted(found) == sorted(scanned(rows))
    assert {f[7] for f in found} >= {"MIT", "ISC", "Apache-2.0", "BSD-3-Clause"}


# --- rule ensemble --------------------------------------------------------------------------------

CLASSES = {
    "capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": "0123456789", "pipes": "|", "marks": "!?", "stops": ".", "commas": ",",
    "symbols": "#*$%&<>@^~{}[]\\=+_", "quotes": "\"'`()", "slashes": "/:;",
}


def plain_statistics(text):
    text = text or ""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    lines = [line for line in text.split("\n") if line]
    per = lambda a, b: a / b if b else 0.0
    out = {
        "log_words": math.log1p(len(words)), "chars_per_word": per(len(text), len(words)), "chars_per_line": per(len(text), len(lines)),
        "distinct_words": per(len(set(words)), len(words)), "distinct_lines": per(len(set(lines)), len(lines)),
    }
    return out | {name: per(sum(c in chars for c in text), len(words)) for name, chars in CLASSES.items()}


def labelled(count):
    texts = []
    for i in range(count):
        good = i % 3 != 0
        text = prose(i, 20 + i % 60) + "." if good else " ".join(f"{w}!|{i % 7}" for w in prose(i, 5 + i % 20).upper().split(" "))
        texts.append((i, text if i % 11 else (text + "\n") * 3, int(good)))
    return texts


def test_rule_ensemble_equals_its_rules(spark):
    """Each score is the logistic of the weights of the rules that hold, over statistics counted in plain Python; a hot id is one more row."""
    texts = labelled(400)
    every = [(i, t) for i, t, _ in texts] + [(j, t) for j, t in edge_texts()] + [(5, "hot id " * k) for k in range(1, 60)]
    docs = spark.createDataFrame(every, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, q) for i, _, q in texts], "doc_id long, quality int")
    model = rule_ensemble.fit(rule_ensemble.statistics(docs), labels)
    assert 2 <= len(model.rules) and any(len(rule.parts) > 1 for rule, _ in model.rules)

    def score(text):
        held = plain_statistics(text)
        margin = model.bias
        for rule, weight in model.rules:
            if all((held[name] <= bound) == at_most for name, at_most, bound in rule.parts):
                margin += weight
        return 1 / (1 + math.exp(-margin))

    found = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, round(r["score"], 9), r["predicted"]) for r in rule_ensemble.classify(docs, labels).collect()))
    expected = sorted((i is not None, i or 0, round(score(t), 9), int(score(t) >= rule_ensemble.THRESHOLD)) for i, t in every)
    assert found == expected


# --- n-gram classifier ----------------------------------------------------------------------------

MASK = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def plain_margin(model, text, log_size):
    """Mean weight of the slots of each kind of n-gram, summed over the kinds."""
    data = (text or "").encode()
    step, gram, byte = int(batches._STEP), int(batches._GRAM), [int(b) for b in batches._BYTE]
    words = [mixed((sum(byte[b] * pow(step, i, 1 << 64) for i, b in enumerate(w)) + len(w)) & MASK) for w in data.split()]
    kinds = []
    for size in quality_rules.WORD_GRAMS:
        slots = []
        for i in range(len(words) - size + 1):
            total = size
            for w in words[i : i + size]:
                total = (total * gram + w) & MASK
            slots.append(mixed(total) >> (64 - log_size))
        kinds.append(slots)
    for size in quality_rules.CHAR_GRAMS:
        kinds.append([mixed((1000 + size + sum(b * pow(step, j + 1, 1 << 64) for j, b in enumerate(data[i : i + size]))) & MASK) >> (64 - log_size) for i in range(len(data) - size + 1)])
    return model.bias + sum(float(np.mean([model.weights[s] for s in slots])) for slots in kinds if slots)


@pytest.mark.parametrize("log_size", [10])
def test_classifier_equals_its_weights(spark, log_size):
    texts = [(i, t + " " + prose(i + 5000, 60), q) for i, t, q in labelled(150)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, q) for i, _, q in texts], "doc_id long, quality int")
    model = quality_rules.fit(docs, labels, log_size=log_size)
    every = [(i, t) for i, t, _ in texts] + [(1000 + n, t) for n, (_, t) in enumerate(edge_texts()) if t is None or len(t) < 6000]
    frame = spark.createDataFrame(every, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["found"] for r in quality_rules.judge(frame, model, "found", log_size=log_size).collect()}
    for i, text in every:
        margin = plain_margin(model, text, log_size)
        chance = 1 / (1 + math.exp(-max(-30, min(30, model.slope * margin + model.shift))))
        assert found[i]["probability"] == pytest.approx(chance, abs=1e-9)
        assert found[i]["kept"] == (not found[i]["base_failed"] and found[i]["probability"] >= quality_rules.KEEP)
    right = [found[i]["probability"] >= 0.5 for i, _, q in texts if q], [found[i]["probability"] < 0.5 for i, _, q in texts if not q]
    assert all(np.mean(r) > 0.9 for r in right)


def test_the_sample_is_bounded_by_bytes(spark):
    """Long labelled texts are fewer rows of the model, and a bound below one text leaves nothing to learn from."""
    texts = [(i, prose(i, 400 + i), i % 2) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in texts], "doc_id long, quality int")
    assert quality_rules.fit(docs, labels, log_size=10, sample_bytes=1000) is None
    small, whole = (quality_rules.fit(docs, labels, log_size=10, sample_bytes=size) for size in (200_000, 64 << 20))
    assert small is not None and not np.array_equal(small.weights, whole.weights)
    assert np.array_equal(whole.weights, quality_rules.fit(docs.repartition(5), labels, log_size=10).weights)
