"""License scans with ordered signature rules.

A text becomes its words (ASCII letters and digits in lower case, and all
other characters), joined by single spaces, so punctuation never matters.
Each rule is a pattern with a keyword, a piece of text that every match
contains: one pass of an Aho-Corasick automaton finds the keywords, and only
rules whose keyword occurs are matched.  Detections are resolved in order of
priority (the rule's kind, then the longer one, then the earlier one, then
the rule's place): one that overlaps or lies inside a kept one is dropped.
The four base phrases are reported whatever the rules say.

Patterns are written in words: ``[x]`` may be left out, ``(a|b)`` is a choice,
``~`` stands for up to eight words.  All repeats are bounded.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
_BASE = re.compile(" (%s)(?= )" % "|".join(BASE))

# Kinds in order of priority, with the confidence of a detection.
KINDS = {"tag": 1.0, "link": 0.95, "notice": 0.9, "title": 0.85, "grant": 0.8, "short": 0.6, "family": 0.5}

# label | titles | links; parts are separated by semicolons.  The words of the
# label itself make a tag, a grant and a short form.
LICENSES = """
gpl-1.0-or-later | gnu general public license ~ version 1 [0] ~ or [at your option] any later version |
gpl-2.0-or-later | gnu general public license ~ version 2 [0] ~ or [at your option] any later version; gnu gpl (version|v) 2 [0] or later; gplv2 or later |
gpl-3.0-or-later | gnu general public license ~ version 3 [0] ~ or [at your option] any later version; gnu gpl (version|v) 3 [0] or later; gplv3 or later |
gpl-1.0 | gnu general public license [as published by the free software foundation] (version|v) 1 [0]; gnu gpl [version] v1 | gnu org licenses [old licenses] gpl 1 0
gpl-2.0 | gnu general public license [as published by the free software foundation] (version|v) 2 [0]; gnu general public license v2 [0]; gnu gpl (version 2|v 2|v2) [0]; gplv2 | gnu org licenses [old licenses] gpl 2 0; opensource org licenses gpl 2 0
gpl-3.0 | gnu general public license [as published by the free software foundation] (version|v) 3 [0]; gnu general public license v3 [0]; gnu gpl (version 3|v 3|v3) [0]; gplv3 | gnu org licenses gpl 3 0; opensource org licenses gpl 3 0
lgpl-2.0 | gnu library general public license [version 2] [0]; lgplv2 | gnu org licenses [old licenses] lgpl 2 0
lgpl-2.1 | gnu lesser general public license ~ (version|v) 2 1; gnu lgpl (version 2|v 2|v2) 1; lgplv2 1 | gnu org licenses [old licenses] lgpl 2 1; opensource org licenses lgpl 2 1
lgpl-3.0 | gnu lesser general public license ~ (version|v) 3 [0]; gnu lgpl (version 3|v 3|v3) [0]; lgplv3 | gnu org licenses lgpl 3 0; opensource org licenses lgpl 3 0
agpl-1.0 | affero general public license (version|v) 1 [0] | affero org oagpl
agpl-3.0 | gnu affero general public license ~ (version|v) 3 [0]; gnu agpl (version 3|v 3|v3) [0]; agplv3 | gnu org licenses agpl 3 0; opensource org licenses agpl 3 0
gfdl-1.1 | gnu free documentation license version 1 1 | gnu org licenses [old licenses] fdl 1 1
gfdl-1.2 | gnu free documentation license version 1 2 | gnu org licenses [old licenses] fdl 1 2
gfdl-1.3 | gnu free documentation license version 1 3 | gnu org licenses fdl 1 3
apache-1.0 | apache license (version|v) 1 0; apache group license 1 0 | apache org licenses license 1 0
apache-1.1 | apache [software] license (version|v) 1 1 | apache org licenses license 1 1; opensource org licenses apache 1 1
apache-2.0 | apache [software] license [as published by the apache software foundation] (version|v) 2 [0]; apache [software] license 2 0; apache [software] license v2 [0] | apache org licenses license 2 0; opensource org licenses apache 2 0
mit | the mit license mit; mit x11 license; x11 mit license; expat mit license | opensource org licenses mit; mit license org
mit-0 | mit no attribution license; mit no attribution | opensource org licenses mit 0; github com aws mit 0
x11 | x11 license; x consortium license | x org releases
bsd-1-clause | bsd 1 clause license; one clause bsd license | opensource org licenses bsd 1 clause
bsd-2-clause | (simplified|freebsd) bsd license; bsd 2 clause license; two clause bsd license | opensource org licenses bsd 2 clause
bsd-3-clause | (new|revised|modified) bsd license; bsd 3 clause license; three clause bsd license | opensource org licenses bsd 3 clause
bsd-4-clause | original bsd license; bsd 4 clause license; four clause bsd license; bsd license with advertising clause | spdx org licenses bsd 4 clause
0bsd | zero clause bsd license; free public license 1 0 0 | opensource org licenses 0bsd
isc | isc license; internet systems consortium license | opensource org licenses isc
zlib | zlib license; zlib libpng license | zlib net zlib license; opensource org licenses zlib
libpng-2.0 | png reference library license version 2 | libpng org pub png src libpng license
bsl-1.0 | boost software license [version] 1 0 | boost org license 1 0; opensource org licenses bsl 1 0
unlicense | the unlicense | unlicense org
wtfpl | do what the fuck you want to public license [version 2] | wtfpl net
mpl-1.0 | mozilla public license [version] 1 0 | mozilla org mpl 1 0; opensource org licenses mpl 1 0
mpl-1.1 | mozilla public license [version] 1 1 | mozilla org mpl 1 1; opensource org licenses mpl 1 1
mpl-2.0 | mozilla public license (version|v) 2 [0]; mozilla public license 2 0 | mozilla org mpl 2 0; opensource org licenses mpl 2 0
epl-1.0 | eclipse public license [version|v] 1 0 | eclipse org legal epl v10; opensource org licenses epl 1 0
epl-2.0 | eclipse public license [version|v] 2 0 | eclipse org legal epl 2 0; opensource org licenses epl 2 0
cddl-1.0 | common development and distribution license [version] 1 0 | opensource org licenses cddl 1 0
cddl-1.1 | common development and distribution license [version] 1 1 | javaee github io glassfish license
cpl-1.0 | common public license [version] 1 0 | opensource org licenses cpl 1 0
cpal-1.0 | common public attribution license [version] 1 0 | opensource org licenses cpal 1 0
ipl-1.0 | ibm public license [version] 1 0 | opensource org licenses ipl 1 0
artistic-1.0 | artistic license [version] 1 0; perl artistic license | opensource org licenses artistic 1 0
artistic-2.0 | artistic license [version] 2 0 | opensource org licenses artistic 2 0; perlfoundation org artistic license 2 0
eupl-1.1 | european union public licence [version|v] 1 1 | opensource org licenses eupl 1 1
eupl-1.2 | european union public licence [version|v] 1 2 | opensource org licenses eupl 1 2
ms-pl | microsoft public license | opensource org licenses ms pl
ms-rl | microsoft reciprocal license | opensource org licenses ms rl
osl-3.0 | open software license [version] 3 0 | opensource org licenses osl 3 0
afl-2.1 | academic free license [version] 2 1 | opensource org licenses afl 2 1
afl-3.0 | academic free license [version] 3 0 | opensource org licenses afl 3 0
ecl-2.0 | educational community license [version] 2 0 | opensource org licenses ecl 2 0
efl-2.0 | eiffel forum license [version] 2 | opensource org licenses efl 2 0
lppl-1.3c | latex project public license [version] 1 3c | latex project org lppl
ofl-1.1 | sil open font license [version] 1 1 | scripts sil org ofl; opensource org licenses ofl 1 1
python-2.0 | python software foundation license [version] 2; psf license agreement | docs python org license
php-3.0 | php license [version] 3 0 | php net license 3 0
php-3.01 | php license [version] 3 01 | php net license 3 01
ruby | ruby license | ruby lang org license
ncsa | university of illinois ncsa open source license | opensource org licenses ncsa
ntp | ntp license | opensource org licenses ntp
openssl | openssl license; openssl and ssleay licenses | openssl org source license
postgresql | postgresql licen(se|ce) | opensource org licenses postgresql
qpl-1.0 | q public license [version] 1 0 | opensource org licenses qtpl
rpl-1.5 | reciprocal public license [version] 1 5 | opensource org licenses rpl 1 5
sleepycat | sleepycat license | opensource org licenses sleepycat
spl-1.0 | sun public license [version] 1 0 | opensource org licenses sunpublic 1 0
upl-1.0 | universal permissive license [version] 1 0 | opensource org licenses upl
vim | vim license | vimhelp org uganda
w3c | w3c software [and document] notice and license | w3 org consortium legal copyright software
wxwindows | wxwindows library licence | opensource org licenses wxwindows
zpl-2.1 | zope public license [version] 2 1 | opensource org licenses zpl 2 1
unicode-dfs-2016 | unicode inc license agreement data files and software | unicode org copyright
json | the json license | json org license
beerware | the beer ware license; beerware license | people freebsd org phk
hippocratic-2.1 | hippocratic license [version] 2 1 | firstdonoharm dev
sspl-1.0 | server side public license [version] 1 | mongodb com licensing server side public license
busl-1.1 | business source license [version] 1 1 | mariadb com bsl11
elastic-2.0 | elastic license [version] 2 [0] | elastic co licensing elastic license
odbl-1.0 | open [data commons open] database license [v] 1 0 | opendatacommons org licenses odbl
odc-by-1.0 | open data commons attribution license [v] 1 0 | opendatacommons org licenses by
pddl-1.0 | public domain dedication and licen(se|ce) [v] 1 0 | opendatacommons org licenses pddl
cc0-1.0 | cc0 1 0 universal; creative commons zero [v] [1] [0] | creativecommons org publicdomain zero 1 0
cc-pdm-1.0 | public domain mark 1 0 | creativecommons org publicdomain mark 1 0
"""
# Creative Commons: each of the six sets of terms in each version.
CC_TERMS = {"by": "attribution", "by-sa": "attribution share[ ]alike", "by-nc": "attribution non[ ]commercial",
            "by-nd": "attribution no derivatives", "by-nc-sa": "attribution non[ ]commercial share[ ]alike",
            "by-nc-nd": "attribution non[ ]commercial no derivatives"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# label: texts of the licenses themselves and of their notices.
NOTICES = """
mit | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
bsd-2-clause | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause | neither the name of ~ nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | all advertising materials mentioning features or use of this software must display the following acknowledg[e]ment
isc | permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby granted
0bsd | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
zlib | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
unlicense | this is free and unencumbered software released into the public domain
wtfpl | you just do what the fuck you want to
apache-2.0 | you may not use this file except in compliance with the license
gpl-2.0-or-later | either version 2 of the license or [at your option] any later version
gpl-3.0-or-later | either version 3 of the license or [at your option] any later version
lgpl-2.1 | either version 2 1 of the license or [at your option] any later version
mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
mpl-2.0 | this source code form is subject to the terms of the mozilla public license v 2 0
epl-1.0 | made available under the terms of the eclipse public license v1 0
epl-2.0 | made available under the terms of the eclipse public license 2 0
cddl-1.0 | the contents of this file are subject to the terms of the common development and distribution license
cc0-1.0 | has waived all copyright and related [or neighboring] rights; dedicated to the public domain by waiving all of his or her rights
ofl-1.1 | this font software is licensed under the sil open font license
beerware | you can buy me a beer in return
json | the software shall be used for good not evil
ms-pl | this license governs use of the accompanying software if you use the software you accept this license
public-domain | (this|the) (work|software|code|file|text) is in the public domain; (placed|released|dedicated) [in|to|into] the public domain; no rights reserved
proprietary | all rights reserved; unauthorized copying of this file ~ is strictly prohibited; proprietary and confidential
"""
# label: names without a version.
FAMILIES = """
gpl | gnu general public license; gnu gpl; general public license
lgpl | gnu lesser general public license; gnu lgpl; lesser general public license
agpl | gnu affero general public license; gnu agpl; affero general public license
gfdl | gnu free documentation license
apache | apache license; apache software license; apache licensed
mit | mit license; mit licence; mit licensed
bsd | bsd license; bsd style license; bsd licence; bsd licensed
cc | creative commons license; creative commons licence; creative commons
cc-by | cc by
cc-by-sa | cc by sa; creative commons attribution share[ ]alike
cc-by-nc | cc by nc; creative commons attribution non[ ]commercial
cc-by-nd | cc by nd; creative commons attribution no derivatives
cc-by-nc-sa | cc by nc sa
cc-by-nc-nd | cc by nc nd
mpl | mozilla public license
epl | eclipse public license
cddl | common development and distribution license
artistic | artistic license
eupl | european union public licence
osl | open software license
afl | academic free license
ofl | open font license
odbl | open database license
psf | python software foundation license
"""
_GRANT = "(licensed|released|distributed|published|available|provided|shared) under [the] [terms of] [the] "
_TERM = re.compile(r"\[([^]]*)\]|\(([^)]*)\)|(~)|([^\s\[\](~)]+)")


def _pattern(phrase: str) -> tuple[str, str]:
    """Regular expression and keyword (its longest fixed part) of a phrase.
    Optional and chosen parts inside a word are written without a space."""
    out, fixed, run = "", [], ""
    for i, m in enumerate(_TERM.finditer(phrase)):
        glued = m.start() > 0 and phrase[m.start() - 1] != " "
        gap = "" if glued or i == 0 else " "
        optional, choice, several, word = m.groups()
        if optional is not None:
            inner = "|".join(map(re.escape, optional.split("|")))
            out += f"(?:{gap}(?:{inner}))?"
        elif choice is not None:
            out += f"{gap}(?:{'|'.join(map(re.escape, choice.split('|')))})"
        elif several:
            out += "(?: [^ ]+){0,8}?"
        else:
            out += gap + re.escape(word)
            run += gap + word
            continue
        fixed.append(run.strip())
        run = ""
    fixed.append(run.strip())
    return f"(?<= ){out}(?= )", max(fixed, key=len)


def _lines(table: str):
    for line in table.strip().splitlines():
        label, *cells = (c.strip() for c in line.split("|", 1))
        yield label, cells[0]


def _parts(cell: str) -> list[str]:
    return [p.strip() for p in cell.split(";") if p.strip()]


def _cells(cell: str) -> tuple[str, str]:
    """Titles and links: the last bar outside of brackets divides them."""
    depth, cut = 0, len(cell)
    for i, ch in enumerate(cell):
        depth += (ch in "[(") - (ch in "])")
        if ch == "|" and depth == 0:
            cut = i
    return cell[:cut], cell[cut + 1:]


def signature_rules() -> list[tuple[str, str, str, str]]:
    """(label, kind, regular expression, keyword) in order of priority."""
    found = []

    def add(label, kind, *phrases, keyword=None):
        for p in phrases:
            regex, fixed = _pattern(p)
            found.append((label, kind, regex, keyword or fixed))

    def named(label, titles, links):
        words = re.sub("[-.]", " ", label.removesuffix("-or-later"))
        later = " or later" if label.endswith("-or-later") else ""
        add(label, "tag", f"spdx license identifier {words}{later}")
        add(label, "grant", f"{_GRANT}{words}{later}", keyword=words + later)
        # a number tells a short form from ordinary words
        add(label, "short" if re.search(r"\d", words) else "title", f"{words}{later}" if re.search(r"\d", words) else f"{words} licen(se|ce)")
        add(label, "title", *titles)
        add(label, "link", *links)

    for label, cell in _lines(LICENSES):
        titles, links = _cells(cell)
        named(label, _parts(titles), _parts(links))
    for terms, name in CC_TERMS.items():
        for version in CC_VERSIONS:
            v = version.replace(".", " ")
            named(f"cc-{terms}-{version}", [f"creative commons {name} [license] [version] {v}", f"creative commons {name} {v} (international|unported|generic)"],
                  [f"creativecommons org licenses {terms.replace('-', ' ')} {v}"])
    for label, cell in _lines(NOTICES):
        add(label, "notice", *_parts(cell))
    for label, cell in _lines(FAMILIES):
        add(label, "family", *_parts(cell))
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda r: rank[r[1]])


_STATE: dict = {}   # per worker process: automaton and compiled rules


def _machine():
    if not _STATE:
        import ahocorasick
        rules = signature_rules()
        by_word: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            by_word.setdefault(r[3], []).append(i)
        for p in BASE:
            by_word.setdefault(p, [])
        machine = ahocorasick.Automaton()
        for w, ids in by_word.items():
            machine.add_word(w, (w, ids))
        machine.make_automaton()
        ranks = [list(KINDS).index(r[1]) for r in rules]
        _STATE.update(machine=machine, rules=rules, ranks=ranks, compiled={})
    return _STATE


def resolve(found: list[tuple[int, int, int]], ranks: list[int]) -> list[tuple[int, int, int]]:
    """Of (start, end, rule) the detections that no detection of a higher
    priority overlaps or contains, by start."""
    kept: list[tuple[int, int, int]] = []
    for d in sorted(found, key=lambda d: (ranks[d[2]], d[0] - d[1], d[0], d[2])):
        i = bisect_right(kept, (d[0], float("inf")))
        if (i == 0 or kept[i - 1][1] <= d[0]) and (i == len(kept) or kept[i][0] >= d[1]):
            insort(kept, d)
    return kept


def scan_text(text: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str, str]]]:
    """Number of words, base places (first word, label), and detections
    (first word, word after the last, label, kind) of a UTF-8 text."""
    words = WORD.findall(text.lower())
    joined = f" {b' '.join(words).decode('latin-1')} "
    state = _machine()
    keywords, ids = set(), set()
    for _, (w, of) in state["machine"].iter(joined):
        if w not in keywords:
            keywords.add(w)
            ids.update(of)
    if not keywords:
        return len(words), [], []
    base = [(m.start() + 1, BASE[m[1]]) for m in _BASE.finditer(joined)] if not keywords.isdisjoint(BASE) else []
    rules, compiled, found = state["rules"], state["compiled"], []
    for i in ids:
        if i not in compiled:
            compiled[i] = re.compile(rules[i][2])
        found += [(m.start(), m.end(), i) for m in compiled[i].finditer(joined)]
    kept = resolve(found, state["ranks"])
    # places in characters become numbers of words in one pass
    number, at, n = {}, 0, 0
    for place in sorted({p for p, _ in base} | {p for d in kept for p in (d[0], d[1] + 1)}):
        n += joined.count(" ", at, place)
        at, number[place] = place, n
    return (len(words), [(number[p] - 1, label) for p, label in base],
            [(number[a] - 1, number[z + 1] - 1, rules[i][0], rules[i][1]) for a, z, i in kept])


def license_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_words, base`` (array of start, label) and ``found``
    (array of start, end, label, kind); places count words from 0, ends are
    exclusive, both arrays are in text order.

    NULL and empty texts have no words; NULL ids and repeated rows get a row
    each; whole texts are scanned; extra columns are not read; an empty table
    gives an empty result.
    """
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    base = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("kind", pa.string())]))

    def run(batches):
        for b in batches:
            out = [scan_text(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array([n for n, _, _ in out], pa.int64()),
                                   pa.array([[{"start": s, "label": x} for s, x in p] for _, p, _ in out], base),
                                   pa.array([[{"start": s, "end": e, "label": x, "kind": k} for s, e, x, k in d] for _, _, d in out], spans)],
                                  ["doc_id", "n_words", "base", "found"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {id_type}, n_words long, base array<struct<start:long,label:string>>, "
                               "found array<struct<start:long,end:long,label:string,kind:string>>")


def license_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score``; the score is the greatest confidence of a detection, a
    base place counting as a family name (no detection: 0)."""
    start, label, kind = (lambda s: s["start"]), (lambda s: s["label"]), (lambda s: s["kind"])
    base, both = F.transform("base", label), F.concat(F.transform("base", label), F.transform("found", label))
    sure = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    scores = F.concat(F.array(F.lit(0.0)), F.transform("found", lambda s: sure[kind(s)]),
                      F.transform("base", lambda s: F.lit(KINDS["family"])))
    return license_spans(docs, doc_id, text).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(F.transform("base", start)).alias("first_word"),
        F.array_max(F.transform("base", start)).alias("last_word"), joined(base).alias("base_labels"),
        joined(both).alias("labels"), F.array_max(scores).alias("score"))
