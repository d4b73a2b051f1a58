import random
import re

from agroflow.llm import licenses

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def by_hand(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_matches_brute_force(spark):
    rng = random.Random(1)
    bits = ["GNU", "General", "public", "License", "apache", "MIT", "cc", "BY", "nc", "4.0", "é", "x\u00a0y", "\u2028", "-", "\n", "version", "3", "Ünder", "\x85"]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(60)))) for i in range(500)]
    rows += [(600, "This is under the GNU General Public License, version 3."), (601, None), (602, ""), (602, ""), (None, "MIT-license"), (603, "mit license " * 20_000)]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, n_words int, labels string")
    got = licenses.scan_licenses(df.repartition(3)).collect()
    mine = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(mine, key=str) == sorted(((i, *by_hand(t)) for i, t in rows), key=str)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in got)


def test_templates_survive_small_edits(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this computer software and associated documentation files (the Software), to deal in the Software without restriction"
    rows = [
        (1, f"/* {mit} */"),
        (2, mit.replace("hereby granted", "granted")),
        (3, "Licensed under the Apache License, Version 2.0"),
        (4, "Licensed under CC BY-NC 4.0."),
        (5, "free of charge to any person"),
        (6, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
        (7, "x " * 2000 + "GNU Affero General Public License"),
    ]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "mit", 2: "", 3: "apache,apache-2.0", 4: "cc-by,cc-by-nc", 5: "", 6: "bsd", 7: "agpl"}
    assert 0.8 <= got[1][1] <= 1 and got[3][1] == 1.0 and got[5][1] == 0.0


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
