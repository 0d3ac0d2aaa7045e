"""License scans: template markup compiled into token automata."""

from __future__ import annotations

import re

from .common import map_rows, table, words

# Phrases of the base rule and license templates. In a template
# [[...]] is optional wording and {{n}} stands for 0 to n words of any kind.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
       "following conditions are met")
BSD_KEEP = (" [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list "
            "of conditions and the following disclaimer in the documentation and or other materials provided with the "
            "distribution")
BSD_ADVERT = (" [[3]] all advertising materials mentioning features or use of this software must display the following "
              "acknowledgement this product includes software developed by {{20}}")
BSD_NAMES = ("neither the name of {{12}} nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission")
BSD_WARRANTY = (" this software is provided by {{12}} as is and any express or implied warranties including but not limited "
                "to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no "
                "event shall {{12}} be liable for any direct indirect incidental special exemplary or consequential damages "
                "including but not limited to procurement of substitute goods or services loss of use data or profits or "
                "business interruption however caused and on any theory of liability whether in contract strict liability "
                "or tort including negligence or otherwise arising in any way out of the use of this software even if "
                "advised of the possibility of such damage")
ISC = ("permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby "
       "granted")
ISC_KEEP = " provided that the above copyright notice and this permission notice appear in all copies"
ISC_WARRANTY = (" the software is provided as is and {{8}} disclaims all warranties with regard to this software including "
                "all implied warranties of merchantability and fitness in no event shall {{8}} be liable for any special "
                "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or "
                "profits whether in an action of contract negligence or other tortious action arising out of or in "
                "connection with the use or performance of this software")
# A text has the label of a license if its whole wording is accepted; START marks a
# first sentence without the wording that has to follow.
START = "-start"
TEMPLATES = {
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files the software to deal in the software without restriction including "
                "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
                "of the software and to permit persons to whom the software is furnished to do so subject to the "
                "following conditions the above copyright notice and this permission notice [[including the next "
                "paragraph]] shall be included in all copies or substantial portions of the software the software is "
                "provided as is without warranty of any kind express or implied including but not limited to the "
                "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
                "{{12}} be liable for any claim damages or other liability whether in an action of contract tort or "
                "otherwise arising from out of or in connection with the software or the use or other dealings in the "
                "software",
    "mit-text-start": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                      "associated documentation files [[the software]] to deal in [[the software]] {{4}} without "
                      "restriction",
    "mit-notice": "[[this {{3}} is]] released under the mit license",
    "apache-2-notice": "licensed under the apache license version 2 0 [[the license]]",
    "gpl-3-notice": "licensed under the gnu general public license [[as published by the free software foundation "
                    "either]] version 3 [[of the license or at your option any later version]]",
    "cc-by-nc-4-notice": "licensed under cc by nc 4 0",
    "bsd-2-text": BSD + BSD_KEEP + BSD_WARRANTY,
    "bsd-3-text": BSD + BSD_KEEP + " [[3]] " + BSD_NAMES + BSD_WARRANTY,
    "bsd-4-text": BSD + BSD_KEEP + BSD_ADVERT + " [[4]] " + BSD_NAMES + BSD_WARRANTY,
    "bsd-text-start": BSD,
    "isc-text": ISC + ISC_KEEP + ISC_WARRANTY,
    "0bsd-text": ISC + ISC_WARRANTY,
    "isc-text-start": ISC,
}


def compile_template(markup):
    """Token automaton: states 0..n; edges[s] = [(word or None for any, next)],
    eps[s] = states reached without a word."""
    edges, eps, opened, s = {}, {}, [], 0
    for tok in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", markup):
        if tok == "[[":
            opened.append(s)
        elif tok == "]]":
            eps.setdefault(opened.pop(), []).append(s)
        elif tok[0] == "{":
            for _ in range(int(tok[2:-2])):
                edges.setdefault(s, []).append((None, s + 1))
                eps.setdefault(s, []).append(s + 1)
                s += 1
        else:
            edges.setdefault(s, []).append((tok.encode(), s + 1))
            s += 1
    return edges, eps, s


def closure(states, eps):
    todo, seen = list(states), set(states)
    while todo:
        for t in eps.get(todo.pop(), ()):
            if t not in seen:
                seen.add(t)
                todo.append(t)
    return seen


def accept(w, at, automaton):
    """End of the longest accepted run of words from at, or None."""
    edges, eps, last = automaton
    states, end, i = closure({0}, eps), None, at
    while states:
        if last in states:
            end = i
        if i >= len(w):
            break
        states = closure({t for s in states for x, t in edges.get(s, ()) if x is None or x == w[i]}, eps)
        i += 1
    return end


def first_words(automaton):
    edges, eps, _ = automaton
    return {x for s in closure({0}, eps) for x, _ in edges.get(s, ())}


def scan(text, phrases, automata, starts):
    w = words(text)
    hits, labels, base, cover = [], set(), set(), set()
    for i, x in enumerate(w):
        if x not in starts:
            continue
        here = set()
        for label in starts[x]:
            if label in phrases:
                p = phrases[label]
                if w[i:i + len(p)] == p:
                    hits.append(i)
                    base.add(label)
                    cover.update(range(i, i + len(p)))
            else:
                end = accept(w, i, automata[label])
                if end is not None:
                    here.add(label)
                    cover.update(range(i, end))
        whole = {label for label in here if not label.endswith(START)}
        labels |= whole or here
    join = lambda s: ",".join(sorted(s))
    return (len(w), len(hits), min(hits, default=None), max(hits, default=None), join(base),
            join(base | labels), len(cover) / len(w) if w else 0.0)


def scan_licenses(docs, templates=TEMPLATES):
    """Licenses named in each whole text. score is the share of words inside
    accepted wording. A label that ends in START says that a first sentence is there
    without the rest of a known license text. Null text has no words: 0 places, null starts, no labels,
    score 0. Repeated rows give repeated results."""
    def start():
        phrases = {k: [x.encode() for x in v.split()] for k, v in PHRASES.items()}
        automata = {k: compile_template(v) for k, v in templates.items()}
        starts = {}
        for k, p in phrases.items():
            starts.setdefault(p[0], []).append(k)
        for k, a in automata.items():
            for x in first_words(a):
                starts.setdefault(x, []).append(k)
        return lambda row: [(row["doc_id"], *scan(row["text"], phrases, automata, starts))]

    return map_rows(docs.select("doc_id", "text"),
                    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                    "base_labels string, labels string, score double", start)


def op3(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))
