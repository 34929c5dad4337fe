import random
import re

from sluiceway.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


def brute(text):
    words = WORDS.findall((text or "").translate(LOWER))
    places = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), labels


BASE = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def test_base_matches_brute_force(odd, frame):
    rng = random.Random(6)
    words = ["GNU", "general", "Public", "license", "apache", "CC", "by", "mit", "é", "x1"]
    gaps = [" ", "-", "\n", ". ", "  ", "_"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    for df in (odd, frame([(i, t, None, None, None) for i, t in enumerate(texts)])):
        want = sorted(((r.doc_id, *brute(r.text)) for r in df.collect()), key=str)
        rows = licenses.scan(df).collect()
        assert sorted(((r.doc_id, *(r[c] for c in BASE)) for r in rows), key=str) == want
        for r in rows:
            assert 0 <= r.score <= 1
            assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}


def found(text):
    scanner = licenses.Scanner(licenses.build_rules())
    return [(d.rule.label, d.start, d.end) for d in scanner.detections(licenses.normalised(text.encode())[0])]


def test_there_are_hundreds_of_rules():
    assert 300 < len(licenses.build_rules()) < 3000


def test_wordings():
    assert found("Licensed under the Apache License, Version 2.0.") == [("apache-2.0", 0, 8)]
    assert found("SPDX-License-Identifier: GPL-3.0-or-later") == [("gpl-3.0-or-later", 0, 8)]
    assert found("code is GPLv2 or any later version") == []  # "gplv2" is one word
    assert found("code is GPL v2 or any later version") == [("gpl-2.0-or-later", 2, 8)]
    assert found("Licensed under CC BY-NC 4.0.") == [("cc-by-nc-4.0", 0, 7)]
    assert found("wir gehen mit dem Hund, cc an alle") == []


def labels_of(frame, *texts):
    rows = licenses.scan(frame([(i, t, None, None, None) for i, t in enumerate(texts)])).collect()
    return [(r.labels, r.score) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_spdx_ids(frame):
    ids = "MIT ISC Zlib BSL-1.0 OFL-1.1 Artistic-2.0 PostgreSQL MIT-0 Unlicense BSD-3-Clause MS-PL".split()
    made = labels_of(frame, *(f"// SPDX-License-Identifier: {i}\nint main() {{}}" for i in ids))
    assert made == [(i.lower(), 1.0) for i in ids]


def test_spdx_expressions(frame):
    texts = ["Apache-2.0 OR MIT", "(MIT OR ISC) AND Zlib", "GPL-2.0-or-later", "MIT and see the notes or curl"]
    made = labels_of(frame, *(f"# SPDX-License-Identifier: {t}" for t in texts))
    assert [x for x, _ in made] == ["apache-2.0,mit", "isc,mit,zlib", "gpl-2.0-or-later", "mit"]


def test_fused_names(frame):
    texts = {
        "code is GPLv2 or any later version": "gpl-2.0-or-later",
        "GPLv3": "gpl-3.0",
        "licensed under the LGPLv2.1": "lgpl-2.1",
        "MPLv2 and AGPL3": "agpl-3.0,mpl-2.0",
        "gplv4": "",
    }
    assert [x for x, _ in labels_of(frame, *texts)] == list(texts.values())


def test_bare_ids(frame):
    texts = {"Released under MIT.": "mit", "licensed under the terms of the ISC": "isc", "wir gehen mit dem Hund": ""}
    assert [x for x, _ in labels_of(frame, *texts)] == list(texts.values())


def test_bodies_without_a_name(frame):
    bsd = """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary
        form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. """
    third = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
        or promote products derived from this software without specific prior written permission. """
    end = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"'
    texts = {
        """Permission is hereby granted, free of charge, to any person obtaining a copy
        of this software and associated documentation files (the "Software"), to deal
        in the Software without restriction""": "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal with the Software without restriction""": "ncsa",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        the rights to use copies, and to permit persons to whom the Software is furnished to do so.
        THE SOFTWARE IS PROVIDED "AS IS\"""": "mit-0",
        """ * Permission to use, copy, modify, and/or distribute this software for any
         * purpose with or without fee is hereby granted, provided that the above""": "isc",
        bsd + end: "bsd,bsd-2-clause",
        bsd + third + end: "bsd,bsd-3-clause",
        """This software is provided 'as-is', without any express or implied warranty. In no
        event will the authors be held liable for any damages arising from the use of this software.""": "zlib",
        """it under the terms of the GNU General Public License as published by the Free Software Foundation;
        either version 2 of the License, or (at your option) any later version.""": "gpl,gpl-2.0-or-later",
    }
    made = labels_of(frame, *texts)
    assert [x for x, _ in made] == list(texts.values())
    assert all(score >= 0.9 for _, score in made)


def test_every_rule_holds_its_keyword():
    """Apart from alternatives, a pattern spells its keyword out."""
    for r in licenses.signatures():
        assert f" {r.keyword} ".strip() in r.pattern or r.rank == 7, r


def test_containment_follows_rank():
    r = [licenses.Rule(k, f"l{k}", "x", 1.0, "x") for k in range(3)]
    kept = licenses._uncontained([(0, 10, r[1]), (2, 5, r[0]), (2, 5, r[2]), (8, 12, r[2]), (0, 10, r[2])])
    # Within a detection of larger rank a smaller one stays; the wider one stays too.
    assert [(s, e, x.rank) for s, e, x in kept] == [(0, 10, 1), (2, 5, 0), (8, 12, 2)]


def test_containment_matches_brute_force():
    rng = random.Random(8)
    rules = [licenses.Rule(k, f"l{k}", "x", 1.0, "x") for k in range(4)]
    for _ in range(400):
        spans = set()
        for _ in range(rng.randint(0, 12)):
            s = rng.randint(0, 12)
            spans.add((s, s + rng.randint(1, 8), rng.randint(0, 3)))
        given = [(s, e, rules[k]) for s, e, k in spans]
        want = {
            a for a in spans
            if not any(b != a and b[0] <= a[0] and a[1] <= b[1] and b[2] <= a[2] for b in spans)
        }
        assert {(s, e, r.rank) for s, e, r in licenses._uncontained(given)} == want


def test_empty(empty):
    assert licenses.scan(empty).count() == 0
