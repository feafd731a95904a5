import hashlib

from conftest_llm import edge_texts
from pyspark.sql import functions as F

from brisa.llm import chat, licenses
from brisa.llm.queries import CONTROLS
from brisa.llm.tokens import tokenizer_path

TURNS = "conv_id long, turn long, role string, text string, ids string, mask string"


def test_chat_reads_back_what_went_in(spark):
    rows = [
        (1, 0, "user", CONTROLS), (1, 1, "assistant", CONTROLS), (2, 1, "assistant", ""), (2, 0, None, None), (3, 2, "assistant", "\n\nb <| <\\| <\\\\| |> <"),
        (3, 1, "sys\ntem\\n<|im_end|>", "é\U0001f600"), (3, 3, "assistant", "\U0001f600日本 x"), (3, 3, "assistant", "\U0001f600日本 x"), (3, None, "user", " "), (None, 0, "assistant", "alone"),
        (4, 0, "assistant", "word " * 30_000),
    ]
    turns = spark.createDataFrame([(*r, "x", "x") for r in rows], TURNS).repartition(3)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(turns, tokenizer_path("byte_bpe_50k.json"))).collect()}
    for conv in (1, 2, 3, 4, None):
        held = sorted([(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in held)
        loss = "".join(text for _, _, role, text in held if role == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(held) and row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_chars"] == len(loss) and row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.format_chats(turns.limit(0), tokenizer_path("byte_bpe_50k.json"))).count() == 0


def test_chat_masks_tokens_of_learned_turns(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi there"), (1, 1, "assistant", "well hello"), (1, 2, "user", "bye")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(turns, tokenizer_path("byte_bpe_50k.json")).first()
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert model.decode(row["ids"]) == row["formatted"]
    assert model.decode([i for i, m in zip(row["ids"], row["mask"]) if m]).strip() == "well hello"


def license_rows(spark, rows):
    return {r["path"]: r for r in licenses.scan(spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, best string")).collect()}


def test_licenses_and_inheritance(spark):
    mit = licenses.TEXTS["MIT"]
    rows = [
        ("a/LICENSE", "MIT License\n\nCopyright (c) 2020 Someone\n\n" + mit),
        ("a/x.py", "code without any"),
        ("a/b/c/y.py", "more code"),
        ("a/b/LICENSE", licenses.TEXTS["ISC"]),
        ("a/b/z.py", "Some prose here.\nLicensed under the Apache License, Version 2.0. And prose goes on, on the same line."),
        ("ab/n.py", "a sibling whose name begins alike"),
        ("q/cc", "Words. Licensed under CC BY-NC 4.0."),
        ("q/gpl", "Words\nThis work is licensed under the GNU General Public License, version 3.\nMore"),
        ("q/mit", "Released under the MIT License."),
        ("q/no", "It is licensed to print money, they said under the general impression of work."),
        (None, None),
        ("q/sub/none", ""),
    ]
    got = license_rows(spark, rows)
    own = {p: got[p]["license"] for p, _ in rows}
    assert own == {"a/LICENSE": "MIT", "a/x.py": None, "a/b/c/y.py": None, "a/b/LICENSE": "ISC", "a/b/z.py": "Apache-2.0", "ab/n.py": None, "q/cc": "CC-BY-NC-4.0", "q/gpl": "GPL-3.0", "q/mit": "MIT", "q/no": None, None: None, "q/sub/none": None}
    assert got["a/x.py"]["inherited"] == "MIT" and got["a/b/c/y.py"]["inherited"] == "ISC" and got["a/b/c/y.py"]["inherited_from"] == "a/b"
    assert got["ab/n.py"]["inherited"] is None and got["a/b/z.py"]["effective"] == "Apache-2.0"
    assert got["q/sub/none"]["inherited"] == "MIT" and got[None]["inherited"] is None  # q/mit is a notice by itself
    assert license_rows(spark, rows[:1]).keys() == {"a/LICENSE"}
    none = spark.createDataFrame([], "doc_id long, path string, text string")
    assert licenses.scan(none).count() == 0


def test_whole_licences_and_joined_headers(spark):
    from pathlib import Path

    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    kept = sorted(file.stem for file in (Path(licenses.__file__).parent / "license_texts").glob("*.txt"))
    assert {"AGPL-3.0", "BSD-2-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "ISC", "MIT"} <= set(kept)
    rows = [(f"sys-{n}/LICENSE", (folder / n).read_text()) for n in names if (folder / n).exists()]
    rows += [(f"own-{n}/LICENSE", f"Copyright (c) 2021 Some One\n\n{(Path(licenses.__file__).parent / 'license_texts' / f'{n}.txt').read_text()}") for n in kept]
    rows += [(p.replace("LICENSE", "src/x.c"), "int main;") for p, _ in rows]
    gnu = "{0} This program is free software: you can redistribute it and/or modify\n{0} it under the terms of the GNU General Public License as published by\n{0} the Free Software Foundation, either version 3 of the License, or\n{0} (at your option) any later version.\n{0}\n{0} This program is distributed in the hope that it will be useful.\n"
    two = gnu.replace("3 of", "2 of").replace("software:", "software;").replace("Foundation,", "Foundation;")
    rows += [
        ("h/gpl3.py", "#!/bin/python\n" + gnu.format("#") + "import os\n"),
        ("h/gpl2.c", "/*\n * Copyright (C) 2020 Some One\n *\n" + two.format(" *") + " */\nint x;\n"),
        ("h/lgpl.c", "/*\n" + two.replace("2 of", "2.1 of").replace("General", "Lesser General").replace("program", "library").format(" *") + " */\n"),
        ("h/apache.js", '// Licensed under the Apache License, Version 2.0 (the "License");\n// you may not use this file except in compliance with the License.\n// You may obtain a copy of the License at\n//\n//     http://www.apache.org/licenses/LICENSE-2.0\n'),
        ("h/mpl.c", "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\n"),
        ("h/spdx.c", "// SPDX-License-Identifier: GPL-2.0-or-later\n"),
        ("h/prose.md", "It is the permission of the author to copy the text that is of use to the reader, and the work of the day is in the notes. " * 30),
    ]
    got = license_rows(spark, rows)
    for path, _ in rows:
        kind, _, rest = path.partition("-")
        want = names.get(rest.split("/")[0], rest.split("/")[0])
        if path.endswith("LICENSE"):
            assert got[path]["is_file"] and got[path]["license"] == want, (path, got[path])
        elif kind in ("sys", "own"):
            assert got[path]["inherited"] == want, path
    own = {p: (r["license"], r["is_file"]) for p, r in got.items() if p.startswith("h/")}
    assert {p: n for p, (n, _) in own.items()} == {"h/gpl3.py": "GPL-3.0", "h/gpl2.c": "GPL-2.0", "h/lgpl.c": "LGPL-2.1", "h/apache.js": "Apache-2.0", "h/mpl.c": "MPL-2.0", "h/spdx.c": "GPL-2.0", "h/prose.md": None}
    assert not own["h/gpl3.py"][1] or own["h/gpl3.py"][0] == "GPL-3.0"


def test_pipeline_stages(spark, edge, empty, tmp_path):
    import corpus_pipeline

    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "nothing like it")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing"]
    for docs in (edge, empty):
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            docs_out = stage(spark, docs, sf)
            assert docs_out.columns == edge.columns
            path = f"{sf}/{number}-{docs is empty}"
            docs_out.write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
        ids = {r["doc_id"] for r in packed.select("doc_id").collect()}
        assert ids == {r["doc_id"] for r in docs.select("doc_id").collect()}
    texts = dict(edge_texts())
    assert ids == set() and texts[1]


def test_pipeline_runs_whole(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    total = rows.agg(F.sum("length").alias("n"), F.countDistinct("doc_id").alias("docs")).first()
    assert total["n"] == rows.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0] and 0 < total["docs"] < 200
