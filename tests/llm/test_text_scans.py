"""Quality rules, license scans, decontamination and secrets."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from dockpulse.llm import decontamination, license_scan, quality_rules, secret_scan
from dockpulse.llm.quality_rules import RULES
from tests.llm.rows import LONG, documents, edge_rows, random_texts


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(spark):
    texts = [t for t in edge_rows()[0] if t is None or len(t) < 5000] + random_texts(1, 60)
    texts += ["a b c d e f\n" * 5, "# * $ % & | < > é", "x\n\nx\n \nx", "Ü" * 30]
    rows = quality_rules.judge(documents(spark, texts)).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        n_words, *_, n_repeat = want = brute_measures(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (n_words < 10 or 100 * n_repeat > 20 * n_words)
        assert not (row.base_failed and row.kept)


def test_verdict_does_not_depend_on_order(spark):
    docs = documents(spark, random_texts(2, 60) + ["# * $ % a b c d e f g h i", "ABC " * 3 + "D E F G H I J K L"])
    one = quality_rules.judge(docs, RULES).drop("n_rules_run")
    two = quality_rules.judge(docs, RULES[::-1]).drop("n_rules_run")
    assert sorted(one.collect()) == sorted(two.collect())


def test_keep_good_keeps_columns(spark):
    texts, ids = edge_rows()
    docs = documents(spark, texts, ids)
    kept = quality_rules.keep_good(docs)
    assert kept.schema == docs.schema
    verdicts = quality_rules.judge(docs)
    assert kept.count() == verdicts.where("kept").count() > 0
    assert quality_rules.keep_good(documents(spark, [])).count() == 0
    assert quality_rules.judge(documents(spark, [])).count() == 0


def test_cheap_rules_that_reject_run_first(spark):
    never = quality_rules.Rule("never", lambda t: bool(t.n_repeat_words) and False)
    always = quality_rules.Rule("always", lambda t: True)
    assert quality_rules.best_order(documents(spark, random_texts(3, 30)), (never, always))[0].name == "always"


def brute_license(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = []
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


LICENSED = [
    "Licensed under the Apache License, Version 2.0.", "x Released under the MIT License. y MIT-license", "CC BY-NC 4.0 licensed under cc by nc 4 0",
    "This work is licensed under the GNU General Public License, version 3.", "cc by cc by cc\nby", "MIT Licenses", "mitlicense",
    "Redistribution and use in source and binary forms, with or without modification, are permitted", "É MIT LICENSE é", "the mit license " * 3,
]


def test_license_base(spark):
    texts = LICENSED + edge_rows()[0]
    rows = license_scan.scan_licenses(documents(spark, texts)).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute_license(text)
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


def brute_templates(text):
    """Every template tried at every place."""
    words = license_scan.words_of((text or "").encode())
    labels, best = set(), 0.0
    for template in license_scan.TEMPLATES:
        wanted = template.text.encode().split()
        for start in range(-len(wanted) + 1, len(words)):
            here = [words[start + i] if 0 <= start + i < len(words) else None for i in range(len(wanted))]
            share = sum(a == b for a, b in zip(here, wanted, strict=True)) / len(wanted)
            line = b" " + b" ".join(w for w in here if w) + b" "
            if share >= license_scan.MIN_COVERAGE and all(b" " + p.encode() + b" " in line for p in template.phrases):
                labels.add(template.label)
                best = max(best, share)
    return labels, best


def test_license_templates(spark):
    texts = LICENSED + ["nothing here", None, ""]
    rows = license_scan.scan_licenses(documents(spark, texts)).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        labels, best = brute_templates(text)
        assert set(filter(None, row.labels.split(","))) == labels | set(filter(None, row.base_labels.split(",")))
        assert row.score == pytest.approx(best)
    assert license_scan.scan_licenses(documents(spark, [])).count() == 0


def items(count=30, seed=5):
    draw = random.Random(seed)
    return [(i, " ".join(draw.choice("abcdefgh") * draw.randint(1, 2) + str(draw.randint(0, 60)) for _ in range(draw.randint(15, 50)))) for i in range(count)]


def test_wand_equals_exhaustive_scores():
    index = decontamination.ItemIndex(items())
    draw = random.Random(6)
    for _ in range(150):
        words = decontamination.words_of(draw.choice(index.items)[1] and b" ".join(draw.choice(index.items)[1]).decode())
        words = [w for w in words if draw.random() < draw.choice([0.4, 0.7, 1])] + decontamination.words_of(items(1, draw.randint(7, 99))[0][1])
        terms = [index.term.get(w, 0) for w in words]
        scores = {}
        for t in set(terms) - {0}:
            for n, x in index.postings[t]:
                scores[n] = scores.get(n, 0.0) + x
        want = {n for n, s in scores.items() if s >= decontamination.MIN_SCORE}
        assert {n for n, _ in index.search(terms)} == want
        assert not want or len(index.candidates(__import__("numpy").array(terms)))


def test_planted_items_are_found_and_clean_texts_left(spark):
    benchmark = items()
    draw = random.Random(8)
    filler = lambda n: " ".join(f"{draw.choice('xyz')}{draw.randint(0, 400)}" for _ in range(n))
    texts, want = [], set()
    for i, (item, text) in enumerate(benchmark):
        texts.append(f"{filler(draw.randint(0, 300))} {text.upper() if i % 3 == 0 else text} {filler(draw.randint(0, 300))}")
        want.add((i, item))
    clean = [filler(500), None, "", LONG]
    docs = documents(spark, texts + clean)
    table = spark.createDataFrame([*benchmark, (None, "a b"), (99, None), (98, "")], "item_id long, text string")
    rows = decontamination.contaminated(docs, table).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    kept = decontamination.without_contaminated(docs, table)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == list(range(len(texts), len(texts) + len(clean)))


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(documents(spark, ["a b c"] * 2), none).count() == 0
    assert decontamination.contaminated(documents(spark, []), none).count() == 0
    assert decontamination.without_contaminated(documents(spark, ["a b c"] * 2), none).count() == 2


def secret_texts(seed, count):
    draw = random.Random(seed)
    texts, real = [], []
    for _ in range(count):
        made = "".join(draw.choice("0123456789abcdef") for _ in range(40))
        digits = "".join(draw.choice("0123456789") for _ in range(16))
        if draw.random() < 0.5:
            texts.append(f"plain words {draw.choice(['token', 'api_key', 'password'])} = \"{made}\" and more")
            real.append(True)
        else:
            texts.append(draw.choice([f"a number {digits} stands here", f"see /var/www/html/page-{digits}/index.html now"]))
            real.append(False)
    return texts, real


def test_forest_on_held_out_findings(spark):
    texts, real = secret_texts(1, 300)
    found = secret_scan.with_features(secret_scan.candidates(documents(spark, texts)))
    truth = spark.createDataFrame(list(enumerate(map(float, real))), "doc_id long, label double")
    model = secret_scan.fitted(found.drop("label").join(truth, "doc_id"))
    more, real = secret_texts(2, 200)
    rows = secret_scan.scored(secret_scan.with_features(secret_scan.candidates(documents(spark, more))), model).collect()
    assert len(rows) == 200
    assert sum(r.secret == real[r.doc_id] for r in rows) >= 195


def test_secret_edges(spark):
    texts, ids = edge_rows()
    assert secret_scan.scan_secrets(documents(spark, texts, ids)).count() == 0
    assert secret_scan.scan_secrets(documents(spark, [])).count() == 0
    some = ["token = \"0123456789abcdef0123456789abcdef\""] * 2
    rows = secret_scan.scan_secrets(documents(spark, some, [None, 3])).collect()
    assert [(r.value, r.place, r.secret) for r in rows] == [("0123456789abcdef0123456789abcdef", 2, True)] * 2


def test_every_secret_of_a_word_is_a_candidate(spark):
    one, two = "wJalrXUtnFEMI1K7MDENG", "0123456789abcdef0123"
    texts = [
        f'{{"aws_secret_access_key":"{one}","other":"{two}"}}', f"x?a={one};b:{two}", "password: hunter", '"pwd": "swordfish!"', "my_password=letmein",
        "token = 'abcd'", "author: Somebody writes", "plain password here", f"token={one}",
    ]
    rows = secret_scan.candidates(documents(spark, texts)).collect()
    found = {i: sorted(r.value for r in rows if r.doc_id == i) for i in range(len(texts))}
    want = [[two, one], [two, f"a={one}"], ["hunter"], ["swordfish!"], ["letmein"], ["abcd"], [], [], [f"token={one}"]]
    assert found == dict(enumerate(want))


def test_training_rows_hold_both_kinds_beside_heavy_vectors(spark):
    """Two vectors have nearly all findings, and the sample is far smaller than either."""
    rows = [(*[float(kind)] * len(secret_scan.FEATURES), float(kind)) for kind in (0, 1) for _ in range(300)]
    labelled = spark.createDataFrame(rows, [*secret_scan.FEATURES, "label"])
    assert secret_scan.fitted(labelled, 20) is not None
    chosen = secret_scan.training_rows(labelled, 20).collect()
    assert sorted((r.label, r.weight) for r in chosen) == [(0.0, 300.0), (1.0, 300.0)]
    assert secret_scan.fitted(labelled.where("label = 1"), 20) is None


def brute_contaminated(docs, benchmark):
    """Every item against every passage, with plain BM25 sums over all items."""
    d = decontamination
    listed = sorted({(i, t) for i, t in benchmark if i is not None and d.words_of(t)})
    words = [d.words_of(t) for _, t in listed]
    mean, stride = sum(map(len, words)) / len(words), max(d.MIN_STRIDE, max(map(len, words)))

    def impact(word, own):
        holding = sum(word in w for w in words)
        tf = own.count(word)
        idf = math.log(1 + (len(words) - holding + 0.5) / (holding + 0.5))
        return idf * tf * (d.K1 + 1) / (tf + d.K1 * (1 - d.B + d.B * len(own) / mean))

    impacts = [{w: impact(w, own) for w in set(own)} for own in words]
    out = {}
    for doc, text in docs:
        body = d.words_of(text)
        for start in range(0, max(1, len(body)), stride):
            passage = body[start : start + 2 * stride]
            for (item, _), own, parts in zip(listed, words, impacts, strict=True):
                score = sum(x for w, x in parts.items() if w in passage) / sum(parts.values())
                if score < d.MIN_SCORE:
                    continue
                size = min(5, len(own))
                here = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
                found = [any(tuple(own[j : j + size]) in here for j in range(max(0, i - size + 1), min(i, len(own) - size) + 1)) for i in range(len(own))]
                cut = len(own) - max(1, round(len(own) * d.ANSWER_SHARE))
                question = sum(found[:cut]) / cut if cut else 1.0
                answer = sum(found[cut:]) / (len(own) - cut)
                runs = {tuple(own[i : i + 13]) for i in range(len(own) - 12)} & {tuple(passage[i : i + 13]) for i in range(len(passage) - 12)}
                if (question >= 0.7 and answer >= 0.5) or runs:
                    out[doc, item] = max(out.get((doc, item), 0), score)
    return out


@pytest.mark.parametrize("index_bytes", [1 << 10, 16 << 20])
def test_contaminated_equals_exhaustive_search(spark, monkeypatch, index_bytes):
    """Items whole, cut short and with other words between; scores do not depend on how many indexes there are."""
    monkeypatch.setattr(decontamination, "INDEX_BYTES", index_bytes)
    benchmark, draw = [*items(24), (7, "another text of item seven " * 5), (None, "a b c"), (3, None), (4, "...")], random.Random(9)
    texts = []
    for _, text in items(24):
        words = text.split()
        cut = words[: round(len(words) * draw.choice([0.3, 0.5, 0.75, 1]))]
        cut = [w if draw.random() > draw.choice([0, 0, 0.2]) else "other" for w in cut]
        texts.append(" ".join(["start"] * draw.randint(0, 150) + cut + ["end"] * draw.randint(0, 150)))
    docs = list(enumerate([*texts, None, "", "start end"]))
    table = spark.createDataFrame(benchmark, "item_id long, text string")
    table = table.union(table.limit(3)).withColumn("word", F.lit("own")).withColumn("shard", F.lit("own"))
    found = decontamination.contaminated(documents(spark, [t for _, t in docs]), table).groupBy("doc_id", "item_id").agg(F.max("score").alias("s"))
    want = brute_contaminated(docs, benchmark)
    got = {(r.doc_id, r.item_id): r.s for r in found.collect()}
    assert set(got) == set(want) and len(want) > 5
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_cut_item_is_found(spark):
    (item,) = items(1, 3)
    words = [f"{w}{i}" for i, w in enumerate(item[1].split() * 3)][:59]
    table = spark.createDataFrame([(1, " ".join(words)), *[(i, t) for i, t in items(20) if i > 1]], "item_id long, text string")
    assert [r.doc_id for r in decontamination.contaminated(documents(spark, [" ".join(words[:44]), " ".join(words[:10])]), table).collect()] == [0]


def test_license_hits_in_linear_time():
    line = b" " + b"cc by " * 80_000
    began = time.perf_counter()
    assert license_scan.places(line, b" cc by ") == list(range(0, 160_000, 2))
    assert time.perf_counter() - began < 1


def test_license_headers(spark):
    texts = {
        "Apache License Version 2.0, January 2004": "apache-2.0", "GNU GENERAL PUBLIC LICENSE Version 3": "gpl-3.0", "The MIT License (MIT)": "mit",
        "# SPDX-License-Identifier: Apache-2.0": "apache-2.0", "SPDX-License-Identifier: MIT": "mit", "GNU General Public License Version 2, June 1991": "gpl-2.0",
    }
    rows = license_scan.scan_licenses(documents(spark, list(texts), [None, 1, 1, 2, 3, None])).collect()
    labels = sorted(r.labels for r in rows)
    assert all(any(want in found.split(",") for found in labels) for want in texts.values())
    assert all(r.score >= license_scan.MIN_COVERAGE for r in rows) and [r.doc_id for r in rows].count(None) == 2


def held_out(seed, count):
    """(text, whether its candidates are secrets): formats that no key name stands by, and what is mistaken for them."""
    draw = random.Random(seed)
    some = lambda chars, n: "".join(draw.choice(chars) for _ in range(n))
    low, digits, mixed = "0123456789abcdef", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    makers = [
        (True, lambda: "AKIA" + some(mixed[:26] + digits, 15) + "7"), (True, lambda: "ghp_" + some(mixed, 35) + "4"),
        (True, lambda: f"eyJhbGciOiJSUzI1NiJ9.eyJzdWIiOiIx{some(mixed, 30)}.{some(mixed, 42)}1"), (True, lambda: f"secret: {some(mixed, 30)}1"),
        (False, lambda: some(digits, 16)), (False, lambda: "-".join(some(low, n) for n in (8, 4, 4, 4, 12))),
        (False, lambda: f"http://git.example.com/c/{some(low, 40)}"), (False, lambda: some(low, 40)),
        (False, lambda: f"/srv/data/{some(digits, 18)}/file.txt"), (False, lambda: f"annual_meeting_schedule_{some(digits, 4)}"),
    ]
    out = []
    for i in range(count):
        real, make = makers[i % len(makers)]
        out.append((f"{draw.choice(['some plain', 'this one', 'as in'])} {make()} {draw.choice(['was here', 'or so', 'then'])}", real))
    return out


def test_unassigned_formats_on_a_held_out_set(spark):
    """Precision and recall of findings with the labels that the operator finds and makes itself."""
    made = held_out(5, 400)
    rows = secret_scan.scan_secrets(documents(spark, [t for t, _ in made] + random_texts(3, 50))).where("doc_id < 400").collect()
    hits = sum(r.secret and made[r.doc_id][1] for r in rows)
    told, real = sum(r.secret for r in rows), sum(made[r.doc_id][1] for r in rows)
    print("precision", hits / told, "recall", hits / real, "of", len(rows))
    assert hits / told >= 0.95 and hits / real >= 0.95


def test_made_findings_are_what_they_say(spark):
    rows = secret_scan.labelled_by_form(secret_scan.made_findings(spark, 200).withColumnRenamed("label", "made")).collect()
    assert {r.doc_id % 10 for r in rows} == set(range(10))
    assert all(r.label == r.made for r in rows if r.label is not None)
