import re

from cases import ROWS, documents
from ledgerpulse.llm.common import plain_words
from ledgerpulse.llm.licenses import PHRASES, TEMPLATES, needed, scan_licenses


def brute_force(rows):
    out = []
    for doc, text, _ in rows:
        words = [w.decode() for w in plain_words(text)]
        places = sorted((i, label) for phrase, label in PHRASES for i in range(len(words))
                        if words[i:i + len(phrase.split())] == phrase.split())
        score, labels, blocks = 0.0, {label for _, label in places}, 0
        base = ",".join(sorted(labels))
        for line in (text or "").split("\n"):
            held, matched = {w.decode() for w in plain_words(line)}, False
            for template, label in TEMPLATES:
                own = set(template.split())
                if len(own & held) >= needed(template):
                    labels, score, matched = labels | {label}, max(score, len(own & held) / len(own)), True
            blocks += matched
        out.append((doc, len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                    base, ",".join(sorted(labels)), score, blocks))
    return sorted(map(str, out))


MORE = [
    (30, "MIT License mit\nlicense Apache\tLicense; GENERAL public-license, license", "en"),
    (31, "license", "en"), (32, "This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0.", "en"),
    (33, "You may not use this file except in compliance with the old License", "en"),
    (34, "the mit under license released and more words\nreleased under the license", "en"), (35, "mit licensé licenseK", "en"),
]


def test_against_brute_force(spark):
    got = scan_licenses(documents(spark, ROWS + MORE))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_force(ROWS + MORE)


def test_empty_table(spark):
    assert scan_licenses(documents(spark, [])).count() == 0


def test_plan_has_no_python(spark, capsys):
    scan_licenses(documents(spark, ROWS)).explain()
    assert not re.search("Python|Pandas|Arrow|ExternalRDD", capsys.readouterr().out.replace("Scan ExistingRDD", ""))


def test_templates_keep_base_labels_apart():
    assert len({t for t, _ in TEMPLATES}) == len(TEMPLATES) < 200


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation"
BSD = " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that"


def test_notices_wrapped_over_lines_and_words_far_apart(spark):
    far = " ".join(f"{w} " + "and so on " * 40 for w in "released under the mit license".split())
    rows = [(1, MIT, "en"), (2, BSD, "en"), (3, far, "en"), (4, f"{far}\n{MIT}\n{BSD}\n{MIT}", "en"), (5, "released\nunder\nthe\nMIT\nlicence", "en")]
    got = {r["doc_id"]: (r["labels"], r["score"], r["n_blocks"]) for r in scan_licenses(documents(spark, rows)).collect()}
    assert got == {1: ("mit", 1.0, 1), 2: ("bsd", 1.0, 1), 3: ("", 0.0, 0), 4: ("bsd,mit", 1.0, 3), 5: ("", 0.0, 0)}
