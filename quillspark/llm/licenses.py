"""License scan: an Aho-Corasick automaton finds identifier tags and notice phrases; expressions are parsed by shunting-yard.

A tag (`SPDX-License-Identifier:`) is followed, on its line, by an expression of identifiers, `and`, `or`, `with` and
parentheses (`with` binds closest, then `and`). Its class is that of the least strict way to comply: `or` takes the
less strict side, `and` the stricter one, `with` relaxes a copyleft by one step. All findings of a document hold
together (and). Phrases are sought after comment marks at line ends and runs of white space are made one blank; the
version of a GNU license is read from what follows its name (`gpl` where none does). Classes: permissive < weak copyleft < strong copyleft < restricted; unknown identifiers are restricted.

Defined results: only documents with a finding give a row; null or empty texts and null ids give none; an expression
that doesn't parse gives `invalid` in `expressions` and makes the document restricted; repeated rows give a row each;
findings are sorted and distinct, so there are no ties; ids are of any type and other columns are ignored; texts of any
length are scanned whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.common import ids_only, type_of

CLASSES = ("permissive", "weak copyleft", "strong copyleft", "restricted")
_NAMES = (
    # identifiers of the SPDX list, by class
    "mit mit-0 mit-cmu mit-modern-variant apache-1.0 apache-1.1 apache-2.0 0bsd bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-3-clause-lbnl bsd-3-clause-attribution bsd-4-clause bsd-4-clause-uc isc zlib libpng libpng-2.0 unlicense cc0-1.0 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 bsl-1.0 python-2.0 psf-2.0 python-2.0.1 wtfpl x11 x11-distribute-modifications-variant xnet postgresql openssl ssleay afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 ecl-1.0 ecl-2.0 php-3.0 php-3.01 ruby tcl ncsa ntp vim blueoak-1.0.0 curl hpnd unicode-dfs-2015 unicode-dfs-2016 unicode-3.0 w3c w3c-20150513 zpl-1.1 zpl-2.0 zpl-2.1 mulanpsl-1.0 mulanpsl-2.0 ftl ijg icu json beerware upl-1.0 odc-by-1.0 pddl-1.0 cdla-permissive-1.0 cdla-permissive-2.0 fsfap fsful fsfullr naist-2003 info-zip artistic-2.0 artistic-1.0 clartistic artistic-1.0-perl artistic-1.0-cl8 bitstream-vera libtiff mitnfa eudatagrid intel xfree86-1.1 w3c-19980720 apafml adobe-2006 adobe-glyph aml ampas bzip2-1.0.6 cnri-python cnri-jython crossword crystalstacker cube diffmark dotseqn dsdp fair giftware glulxe gsoap-1.3b imagemagick jasper-2.0 leptonica linux-openib mirOS mtll naumen netcdf newsletr nlpl nrl ogc-1.0 oldap-2.8 plexus psfrag psutils qhull rsa-md saxpath sendmail sgi-b-2.0 smlnj swl tcp-wrappers torque-1.1 zed zend-2.0 zimbra-1.3".lower(),
    "lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later lgpllr mpl-1.0 mpl-1.1 mpl-2.0 mpl-2.0-no-copyleft-exception epl-1.0 epl-2.0 cddl-1.0 cddl-1.1 cc-by-sa-1.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 cpl-1.0 ipl-1.0 apsl-1.0 apsl-2.0 eupl-1.0 eupl-1.1 eupl-1.2 ms-pl ms-rl ofl-1.0 ofl-1.1 ofl-1.1-rfn ofl-1.1-no-rfn odbl-1.0 cecill-c cecill-b cecill-2.0 cecill-2.1 npl-1.0 npl-1.1 spl-1.0 nokia qpl-1.0 osl-1.0 osl-2.0 osl-2.1 osl-3.0 cdla-sharing-1.0 gfdl-1.1 gfdl-1.1-only gfdl-1.1-or-later gfdl-1.2 gfdl-1.2-only gfdl-1.2-or-later gfdl-1.3 gfdl-1.3-only gfdl-1.3-or-later erlpl-1.1 watcom-1.0 sugarcrm-1.1.3 lppl-1.0 lppl-1.1 lppl-1.2 lppl-1.3a lppl-1.3c cern-ohl-w-2.0 cern-ohl-p-2.0 motosoto ngpl rpsl-1.0 simpl-2.0 nasa-1.3 latex2e frameworx-1.0 catosl-1.1",
    "gpl gpl-1.0 gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later agpl-1.0 agpl-1.0-only agpl-1.0-or-later agpl-3.0 agpl-3.0-only agpl-3.0-or-later sspl-1.0 rpl-1.1 rpl-1.5 cern-ohl-s-2.0 cal-1.0 sleepycat parity-6.0.0 parity-7.0.0 oset-pl-2.1 ogtsl copyleft-next-0.3.0 copyleft-next-0.3.1",
    "cc-by-nc-1.0 cc-by-nc-2.0 cc-by-nc-2.5 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-sa-1.0 cc-by-nc-sa-2.0 cc-by-nc-sa-2.5 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-1.0 cc-by-nd-2.0 cc-by-nd-2.5 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-nc-nd-1.0 cc-by-nc-nd-2.0 cc-by-nc-nd-2.5 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 busl-1.1 elastic-2.0 polyform-noncommercial-1.0.0 polyform-small-business-1.0.0 proprietary",
)
KNOWN = {name: k for k, names in enumerate(_NAMES) for name in names.split()}
TAG = "spdx-license-identifier:"
PHRASES = {
    "the mit license": "mit", "under the mit licence": "mit", "permission is hereby granted, free of charge": "mit",
    "apache license, version 2.0": "apache-2.0", "apache license 2.0": "apache-2.0", "apache-2.0 license": "apache-2.0",
    "gnu general public license, version 3": "gpl-3.0", "gnu general public license version 3": "gpl-3.0", "gnu gpl v3": "gpl-3.0",
    "gnu general public license, version 2": "gpl-2.0", "gnu general public license version 2": "gpl-2.0", "gnu gpl v2": "gpl-2.0",
    "gnu affero general public license": "agpl-3.0", "gnu lesser general public license": "lgpl-3.0", "mozilla public license": "mpl-2.0", "eclipse public license": "epl-2.0",
    "redistribution and use in source and binary forms": "bsd-3-clause", "bsd 3-clause": "bsd-3-clause", "bsd 2-clause": "bsd-2-clause", "isc license": "isc",
    "cc by 4.0": "cc-by-4.0", "cc by-sa 4.0": "cc-by-sa-4.0", "cc by-nc 4.0": "cc-by-nc-4.0", "cc by-nc-sa 4.0": "cc-by-nc-sa-4.0", "cc by-nd 4.0": "cc-by-nd-4.0", "cc0 1.0": "cc0-1.0",
    "boost software license": "bsl-1.0", "the unlicense": "unlicense", "this is free and unencumbered software released into the public domain": "unlicense", "do what the fuck you want to public license": "wtfpl", "zlib license": "zlib", "python software foundation license": "psf-2.0", "artistic license 2.0": "artistic-2.0", "academic free license": "afl-3.0", "sil open font license": "ofl-1.1", "open database license": "odbl-1.0", "european union public licence": "eupl-1.2", "common development and distribution license": "cddl-1.0", "microsoft public license": "ms-pl", "server side public license": "sspl-1.0", "business source license 1.1": "busl-1.1", "elastic license 2.0": "elastic-2.0", "universal permissive license": "upl-1.0", "bsd 4-clause": "bsd-4-clause", "bsd zero clause": "0bsd", "mulan psl v2": "mulanpsl-2.0",
    "cc by 3.0": "cc-by-3.0", "cc by-sa 3.0": "cc-by-sa-3.0", "cc by-nc 3.0": "cc-by-nc-3.0", "cc by-nc-sa 3.0": "cc-by-nc-sa-3.0", "cc by-nc-nd 3.0": "cc-by-nc-nd-3.0", "cc by-nc-nd 4.0": "cc-by-nc-nd-4.0", "creative commons attribution-sharealike 4.0": "cc-by-sa-4.0", "creative commons attribution-noncommercial 4.0": "cc-by-nc-4.0",
    "creative commons attribution 4.0": "cc-by-4.0", "public domain dedication": "cc0-1.0", "all rights reserved": "proprietary",
}
_MARKS = re.compile(r"(?m)^[ \t]*(?:[*#;%/!>|-]+|<!--|(?:rem|dnl)(?=\s))[ \t]*|[ \t]*(?:\*+/|-->)[ \t]*$")
_GNU = re.compile(
    r"\bgnu (?:(lesser|library|affero) )?(?:general public licen[sc]e|(l|a)?gpl)(?=v\d|\W|$)[\s,;:()\"']*(?:as published by the free software foundation[\s,;:]*)?"
    r"(?:either )?(?:v(?:ersion|\.)? ?(\d+)(?:\.(\d+))?)?"
)
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")
_BINDS = {"or": 1, "and": 2, "with": 3}


def parse(text: str) -> list[str] | None:
    """The expression at the start of text in reverse Polish order; None if it doesn't parse.

    It ends with the line or where two operands meet with no operator between them (prose that follows), if no
    parenthesis is open there."""
    out, ops, operand, depth = [], [], True, 0
    for t in _TOKEN.findall(text.lower().split("\n", 1)[0]):
        t = t.rstrip(".-") or t
        if operand:
            if t == "(":
                ops.append(t)
                depth += 1
            elif t in _BINDS or t == ")":
                return None
            else:
                out.append(t)
                operand = False
        elif t == ")":
            if not depth:
                break
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
            depth -= 1
        elif t in _BINDS:
            while ops and ops[-1] != "(" and _BINDS[ops[-1]] >= _BINDS[t]:
                out.append(ops.pop())
            ops.append(t)
            operand = True
        elif depth:
            return None
        else:
            break
    if operand or depth:
        return None
    return out + ops[::-1]


def strictness(rpn: list[str]) -> int:
    """Index of the class of an expression."""
    stack: list[int | str] = []
    for t in rpn:
        if t in _BINDS:
            b, a = stack.pop(), stack.pop()
            if t == "with":
                x = _level(a)
                stack.append(max(0, x - 1) if x < 3 else 3)
            else:
                stack.append((min if t == "or" else max)(_level(a), _level(b)))
        else:
            stack.append(t)
    return _level(stack[0])


def _level(x: int | str) -> int:
    return x if isinstance(x, int) else KNOWN.get(x, KNOWN.get(x.rstrip("+"), 3))


def plain(low: str) -> str:
    """Without comment marks at the ends of lines, and with one blank for each run of white space."""
    return " ".join(_MARKS.sub(" ", low).split())


def gnu(text: str) -> set[str]:
    """GNU licenses of a plain text, with the version that follows the name."""
    out = set()
    for m in _GNU.finditer(text):
        kind = {"lesser": "lgpl", "library": "lgpl", "affero": "agpl"}.get(m[1], f"{m[2] or ''}gpl")
        version = f"{m[3]}.{m[4] or 0}" if m[3] else {"lgpl": "2.0" if m[1] == "library" else "3.0", "agpl": "3.0"}.get(kind)
        out.add(f"{kind}-{version}" if version else kind)
    return out


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for p, name in PHRASES.items():
        a.add_word(p, (name, len(p)))
    a.add_word(TAG, (None, len(TAG)))
    a.make_automaton()
    return a


def scan(low: str, a: ahocorasick.Automaton) -> tuple[list[str], str] | None:
    """Distinct expressions of a lower-case text, in order, and the document's class; None without a finding.

    A phrase counts only where no word character follows or precedes it."""
    text = plain(low)
    found = gnu(text) if "gnu " in text else set()
    for end, (name, n) in a.iter(low) if TAG in low else ():
        if name is None:
            rpn = parse(low[end + 1 : low.find("\n", end) if low.find("\n", end) >= 0 else None])
            found.add(" ".join(rpn) if rpn else "invalid")
    for end, (name, n) in a.iter(text):
        before, after = text[end - n : end - n + 1] if end >= n else "", text[end + 1 : end + 2]
        if name is not None and not (before.isalnum() or after.isalnum() or text.startswith("gnu ", end - n + 1)):
            found.add(name)
    if not found:
        return None
    worst = max(3 if x == "invalid" else strictness(x.split(" ")) for x in found)
    return sorted(found), CLASSES[worst]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = automaton()
    for b in batches:
        rows = []
        for i, t in enumerate(b.column("text")):
            got = scan(t.as_py().lower(), a)
            if got:
                rows.append((i, *got))
        cols = list(zip(*rows, strict=True)) or [[]] * 3
        ids = b.column("doc_id").take(pa.array(cols[0], pa.int64()))
        yield pa.record_batch([ids, pa.array(cols[1], pa.list_(pa.string())), pa.array(cols[2], pa.string())], names=["doc_id", "expressions", "license_class"])


def licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, expressions, license_class): expressions are identifiers or reverse Polish expressions, sorted."""
    own = ids_only(docs)
    return own.where("doc_id is not null and text is not null").mapInArrow(_scan, f"doc_id {type_of(own)}, expressions array<string>, license_class string")
