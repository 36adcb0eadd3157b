"""License scan by sentence rules.

A document is cut into pieces (line breaks, and ``. ! ? ;`` followed by white
space).  A piece is normalised (lower case, letters and digits only, single
spaces).  A known licence sentence begins at any word of a piece, unless a word
of ``NOT`` stands before it, and ends with that piece or with one of the next
ones, so hard-wrapped text is found, also behind comment marks; the first one
wins, of those that begin alike the longest.  ``<...>`` in a known sentence stands
for 1 to ``FIELD_WORDS`` words (a holder's name).  An SPDX tag is a sentence that
may also end before ``or``, ``and`` or ``with``: of an expression the first licence
is named, and a plus sign is not read.  The sequence of identifiers found in a document is
then matched against ordered rules: at each place the first rule of the list
whose identifiers follow one another, with at most ``gap`` other sentences
between two of them, names the licence, and matching goes on behind it.  Between
known sentences, lines count as one sentence up to ``. ! ? ;`` or a blank line;
pieces without letters and digits count as nothing.

Defined results: null and empty texts have no match; a repeated notice is
matched once per occurrence; rows are judged one by one, so repeated rows and
ids do not matter.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from incidentlab.llm.textops import add_text_columns

#: Known licence sentences (fixed values, from the public licence texts).  More
#: are made from the names below.
SENTENCES = {
    "apache-ref": "Licensed under the Apache License, Version 2.0.",
    "mit-ref": "Released under the MIT License.",
    "gpl3-ref": "This work is licensed under the GNU General Public License, version 3.",
    "by-nc-ref": "Licensed under CC BY-NC 4.0.",
    "by-ref": "Licensed under CC BY 4.0.",
    "by-sa-ref": "Licensed under CC BY-SA 4.0.",
    "mit-title": "The MIT License (MIT)",
    "mit-short-title": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.",
    "apache-under": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of <holder> nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
    "bsd-endorse-or": "Neither the name of <holder> nor the names of <contributors> may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
    "bsd-endorse-names": "The names of <contributors> may not be used to endorse or promote products derived from this "
    "software without specific prior written permission.",
    "bsd-endorse-name": "The name of <holder> may not be used to endorse or promote products derived from this software "
    "without specific prior written permission.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by <holder>.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
    "software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
    "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
    "third-parties to whom the Software is furnished to do so, all subject to the following:",
    "postgresql-grant": "Permission to use, copy, modify, and distribute this software and its documentation for any "
    "purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice "
    "and this paragraph and the following two paragraphs appear in all copies.",
    "epl1-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License v1.0 which accompanies this distribution, and is available at "
    "http://www.eclipse.org/legal/epl-v10.html",
    "epl2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "cc0-dedicated": "The person who associated a work with this deed has dedicated the work to the public domain by "
    "waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring "
    "rights, to the extent allowed by law.",
}

#: (licence, identifiers in order); the first fitting rule wins.  More are made
#: from the names below.
RULES = (
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-or")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-names")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-name")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice")),
    ("MIT", ("mit-short-title", "mit-grant", "mit-notice")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-ref",)),
    ("Apache-2.0", ("apache-under", "apache-comply", "apache-copy")),
    ("Apache-2.0", ("apache-under", "apache-comply")),
    ("Apache-2.0", ("apache-ref",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("CC-BY-NC-4.0", ("by-nc-ref",)),
    ("CC-BY-SA-4.0", ("by-sa-ref",)),
    ("CC-BY-4.0", ("by-ref",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-grant-and",)),
    ("0BSD", ("0bsd-grant",)),
    ("Zlib", ("zlib-grant",)),
    ("Unlicense", ("unlicense-free",)),
    ("MPL-2.0", ("mpl2-subject",)),
    ("BSL-1.0", ("bsl-grant",)),
    ("PostgreSQL", ("postgresql-grant",)),
    ("EPL-1.0", ("epl1-terms",)),
    ("EPL-2.0", ("epl2-terms",)),
    ("CC0-1.0", ("cc0-dedicated",)),
)

#: SPDX identifier -> names used in references (fixed values).
NAMES = {
    "MIT": ("MIT License", "MIT licence"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License", "3-Clause BSD License"),
    "BSD-4-Clause": ("BSD 4-Clause License",),
    "0BSD": ("BSD Zero Clause License",),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "Unlicense": ("Unlicense",),
    "MPL-1.1": ("Mozilla Public License 1.1", "Mozilla Public License, version 1.1"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0"),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License, Version 1.0"),
    "Artistic-2.0": ("Artistic License 2.0",),
    "EUPL-1.2": ("European Union Public Licence 1.2", "European Union Public License 1.2"),
    "PostgreSQL": ("PostgreSQL License",),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "CC0 1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": (
        "CC BY-NC-SA 4.0",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC-ND-4.0": (
        "CC BY-NC-ND 4.0",
        "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    ),
}
#: GNU licences: SPDX identifier, name, versions (fixed values).
GNU = (
    ("GPL", "GNU General Public License", ("2", "3")),
    ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
    ("AGPL", "GNU Affero General Public License", ("3",)),
)
REFERENCES = ("licensed under", "released under", "distributed under", "available under", "covered by")


def _generated() -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    """Sentences and rules of references by name, SPDX tags and GNU notices."""
    sentences: dict[str, str] = {}
    rules = []

    def add(licence: str, kind: str, text: str) -> None:
        key = f"{kind}-{len(sentences)}"
        sentences[key] = text
        rules.append((licence, (key,)))

    def refer(licence: str, name: str) -> None:
        for verb in REFERENCES:
            for article in ("", "the "):
                add(licence, "name", f"{verb} {article}{name}.")

    for licence, names in NAMES.items():
        add(licence, "spdx", f"SPDX-License-Identifier: {licence}")
        for name in names:
            refer(licence, name)
    for code, name, versions in GNU:
        for version in versions:
            own = f"{code}-{version if '.' in version else version + '.0'}"
            for tag, suffix in (("", ""), ("-only", ""), ("-or-later", "-or-later")):
                add(own + suffix, "spdx", f"SPDX-License-Identifier: {own}{tag}")
            for number in (f"version {version}", f"v{version}", f"v{version}.0", f"version {version}.0"):
                refer(own, f"{name}, {number}")
                refer(f"{own}-or-later", f"{name}, {number} or later")
            for subject in ("program", "library", "software"):
                for either in ("either version", "version"):
                    add(
                        f"{own}-or-later",
                        "gnu",
                        f"This {subject} is free software; you can redistribute it and/or modify it under the terms of "
                        f"the {name} as published by the Free Software Foundation; {either} {version} of the License, "
                        "or (at your option) any later version.",
                    )
                add(
                    own,
                    "gnu",
                    f"This {subject} is free software; you can redistribute it and/or modify it under the terms of the "
                    f"{name} version {version} as published by the Free Software Foundation.",
                )
    return sentences, rules


def _merged() -> tuple[dict[str, str], tuple]:
    """The stated and the generated ones; of equal sentences the stated one."""
    sentences, rules = dict(SENTENCES), list(RULES)
    known = {" ".join(re.findall("[a-z0-9]+", s.lower())) for s in sentences.values()}
    generated, own_rules = _generated()
    for licence, (key,) in own_rules:
        words = " ".join(re.findall("[a-z0-9]+", generated[key].lower()))
        if words not in known:
            known.add(words)
            sentences[key] = generated[key]
            rules.append((licence, (key,)))
    return sentences, tuple(rules)


SENTENCES, RULES = _merged()
GAP = 2
FIELD_WORDS = 12
NOT = ("not", "never", "longer")
SPDX_ENDS = ("or", "and", "with")

MATCHES = "array<struct<license:string,start:int,end:int>>"

_CUT = re.compile(r"[^\n\r]+?(?:[.!?;](?=\s)|(?=[\n\r])|\Z)")
_BREAK = re.compile(r"\r\n|\n|\r")
_ALNUM = re.compile(r"[^\W_]")
_WORD = re.compile(r"[A-Za-z0-9]+")
_PART = re.compile(r"<[^>]*>|[a-z0-9]+")
_FIELD = "<>"  # key of a field in the tree of words


class Recogniser:
    def __init__(self, sentences: dict = SENTENCES, rules: tuple = RULES, gap: int = GAP):
        # Tree of words; the key None holds the identifier of the sentence that ends there.
        self.known: dict = {}
        begin: dict[str, set] = {}
        for key, sentence in sentences.items():
            node, words = self.known, [_FIELD if w[0] == "<" else w for w in _PART.findall(sentence.lower())]
            for word in words:
                node = node.setdefault(word, {})
            node[None] = key
            begin.setdefault(words[0], set()).add(words[1] if len(words) > 1 else "")
        # Texts and pieces without the first two words of any sentence are passed over.
        either = "|".join(
            f"{first}[^a-z0-9]+(?:{'|'.join(sorted(seconds))})" if "" not in seconds else first
            for first, seconds in sorted(begin.items())
        )
        self.anchor = re.compile(either) if begin else None
        self.starts: dict[str, list] = {}
        for name, ids in rules:
            self.starts.setdefault(ids[0], []).append((name, ids))
        self.gap = gap

    def _longest(self, words: list, first: int, at: int):
        """(identifier, last piece) of the longest known sentence that begins
        at a word of a piece, or None; ``words`` holds the words of each piece."""
        states, best = [(self.known, 0)], None  # node, words that its field may still take
        for last in range(first, len(words)):
            for _, word in words[last][at:] if last == first else words[last]:
                after = []
                for node, left in states:
                    if last == first and word in SPDX_ENDS and str(node.get(None)).startswith("spdx-"):
                        best = node[None], last
                    if word in node:
                        after.append((node[word], 0))
                    if _FIELD in node:
                        after.append((node[_FIELD], FIELD_WORDS - 1))
                    if left:
                        after.append((node, left - 1))
                states = after
                if not states:
                    return best
            if not words[last]:
                return best
            for node, _ in states:
                if None in node:
                    best = node[None], last
        return best

    def _first(self, words: list, first: int):
        """(place of its first word, identifier, last piece) of the first known
        sentence that begins in a piece, or None."""
        for at, (_, word) in enumerate(words[first]):
            if word in self.known and (not at or words[first][at - 1][1] not in NOT):
                if hit := self._longest(words, first, at):
                    return at, *hit
        return None

    def identify(self, text: str) -> list[tuple[int, str, int, int]]:
        """(sentence number, identifier, start, end) of the known sentences."""
        if self.anchor is None or not self.anchor.search(text.lower()):
            return []
        pieces = [(m.start(), m.end()) for m in _CUT.finditer(text) if _ALNUM.search(m.group())]
        words = [[(m.start(), m.group().lower()) for m in _WORD.finditer(text, a, b)] for a, b in pieces]
        found, number, i, ended = [], -1, 0, True
        while i < len(pieces):
            start, end = pieces[i]
            if hit := self._first(words, i):
                at, key, last = hit
                found.append((number + 1, key, words[i][at][0] if at else start, pieces[last][1]))
                number, i, ended = number + 1, last, True
            else:
                if ended or len(_BREAK.findall(text, pieces[i - 1][1], start)) > 1:
                    number += 1
                ended = text[end - 1] in ".!?;"
            i += 1
        return found

    def match(self, text: str) -> list[tuple[str, int, int]]:
        """(licence, start, end) in order; offsets are code points."""
        ids, out, i = self.identify(text), [], 0
        while i < len(ids):
            for name, rule in self.starts.get(ids[i][1], ()):
                own = ids[i : i + len(rule)]
                if tuple(x[1] for x in own) == rule and all(
                    b[0] - a[0] - 1 <= self.gap for a, b in zip(own, own[1:])
                ):
                    out.append((name, own[0][2], own[-1][3]))
                    i += len(rule)
                    break
            else:
                i += 1
        return out


def scan_licenses(
    docs: DataFrame, text_col: str = "text", sentences: dict = SENTENCES, rules: tuple = RULES, gap: int = GAP
) -> DataFrame:
    """``docs`` with ``matches`` (licence and span of each notice) added."""

    def start():
        recogniser = Recogniser(sentences, rules, gap)

        def apply(texts):
            return [
                [[{"license": n, "start": a, "end": b} for n, a, b in recogniser.match(t or "")] for t in texts]
            ]

        return apply

    return add_text_columns(docs, text_col, f"matches {MATCHES}", start)
