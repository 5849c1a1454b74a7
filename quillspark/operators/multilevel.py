"""From flat lists of numbered sections to levels: serial numbers of headlines, the longest sparse chain, nesting.

A kernel on plain values; `restructure` applies it to every document's tree.
A serial is a tuple of levels; END + k stands for the k-th position from the end, after any number.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

END = 1 << 40
UNKNOWN, ARABIC, ROMAN, LATIN = "UNKNOWN", "ARABIC", "ROMAN", "LATIN"
Serial = tuple[int, ...]
Format = tuple[str, ...]

_ROMAN = "X{1,3}(?:IX|IV|V?I{0,3})|IX|IV|VI{0,3}|I{1,3}"
_LEVEL = rf"(?:{_ROMAN}|\d+|[A-Z])"
_SPACED = rf"(?:{_ROMAN}|\d+)"
_SERIAL = rf"{_LEVEL}(?:\s+\.\s+{_SPACED}|\.{_LEVEL})*\.?"
_FLAGS = re.I | re.A
LENIENT = re.compile(rf"(?:^|[\s(])(?P<n>{_SERIAL})(?=$|[\s)])", _FLAGS)
_LEAD = r"(?:^|(?P<named>part|chapter|section)\W+|^\W+)"
STRICT = re.compile(rf"{_LEAD}(?P<n>{_SERIAL})(?=\W|$)", _FLAGS)
NUMBERED = re.compile(rf"{_LEAD}(?P<n>{_SPACED}(?:\s+\.\s+{_SPACED}|\.{_SPACED})*\.?)(?=\W|$)", _FLAGS)
INTRO = re.compile(r"\W*introduction\W*", _FLAGS)
STICKY = re.compile(rf"[1I]?\W*introduction\b.*$|(?:part|chapter|section)\W+{_SERIAL}(?=\W|$)", _FLAGS)
ENDINGS = {k: re.compile(rf"(?:.*\s)?(?:{p})(?:\s.+)?$", _FLAGS) for k, p in {"conclusion": "conclusions?|discussion", "appendix": "appendix", "acknowledgement": "acknowledgement", "references": "references"}.items()}


def roman(s: str) -> int:
    value = {"I": 1, "V": 5, "X": 10}
    total = 0
    for a, b in zip(s, s[1:] + " ", strict=True):
        total += -value[a] if value.get(b, 0) > value[a] else value[a]
    return total


def to_roman(n: int) -> str:
    return "X" * (n // 10) + ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"][n % 10]


def guess(headline: str | None, strict: bool = False) -> tuple[Serial, Format] | None:
    """Serial and formats that a headline seems to have."""
    if headline is None:
        return None
    m = (STRICT if strict else LENIENT).search(headline)
    if not m:
        return ((1,), (UNKNOWN,)) if INTRO.match(headline) else None
    number, form = [], []
    for part in m["n"].rstrip(".").split("."):
        p = part.strip().upper()
        if p.isdigit():
            number.append(int(p)), form.append(ARABIC)
        elif p and set(p) <= set("IVX"):
            number.append(roman(p)), form.append(ROMAN)
        elif len(p) == 1:
            number.append(ord(p) - 64), form.append(LATIN)
        else:
            return None
    return tuple(number), tuple(form)


def sparsity(f: Serial, s: Serial) -> int:
    """Least number of headings that must lie between two serials; -1 if the second isn't greater."""
    steps = 0
    while s and f < s:
        d = s[0] - f[0]
        if d > END // 2:
            d = 1
        steps += d
        f = f[1:] if d == 0 and len(f) > 1 else (0,)
        s = s[1:]
    return steps - 1


def formats_match(a: Format, b: Format) -> bool:
    return all(x == y or UNKNOWN in (x, y) for x, y in zip(a, b, strict=False))


def follows(f: Serial | None, s: Serial | None, ff: Format | None = None, sf: Format | None = None, most: int = 0) -> bool:
    return f is not None and s is not None and f < s and sparsity(f, s) <= most and (ff is None or sf is None or formats_match(ff, sf))


def repair_roman(nums: list, forms: list) -> None:
    """A roman numeral that doesn't fit between its neighbours becomes a letter if that fits, or at least fits better."""
    last = len(nums) - 1
    if last < 1:
        return
    for i in range(last + 1):
        if nums[i] is None or ROMAN not in forms[i]:
            continue
        fits = lambda n, f, after, af: (i == 0 or follows(nums[i - 1], n, forms[i - 1], f)) and (i == last or follows(n, after, f, af))  # noqa: B023, E731
        after = nums[i + 1] if i < last else None
        if fits(nums[i], forms[i], after, forms[i + 1] if i < last else None):
            continue
        num, form = list(nums[i]), list(forms[i])
        nxt, nxt_form = (list(after), list(forms[i + 1])) if after is not None else (None, None)
        for p, kind in enumerate(forms[i]):
            if kind != ROMAN:
                continue
            was, letter = nums[i][p], to_roman(nums[i][p])
            if len(letter) != 1:
                continue
            num[p], form[p] = ord(letter) - 64, LATIN
            if nxt is not None and p < len(nxt) and nxt_form[p] == ROMAN:
                other = to_roman(nxt[p])
                if len(other) != 1:
                    num[p], form[p] = was, ROMAN
                    continue
                nxt[p], nxt_form[p] = ord(other) - 64, LATIN
            ok = fits(tuple(num), tuple(form), None if nxt is None else tuple(nxt), None if nxt is None else tuple(nxt_form))
            if not ok and i > 0 and nums[i - 1] is not None and p < len(forms[i - 1]) and forms[i - 1][p] == LATIN:
                left = nums[i - 1][p]
                ok = left <= num[p] and (was < left or was > num[p])
            if not ok and nxt is not None and p < len(nxt_form) and nxt_form[p] == LATIN:
                ok = num[p] <= nxt[p] and (nxt[p] < was or was < num[p])
            if not ok:
                num[p], form[p] = was, ROMAN
        nums[i], forms[i] = tuple(num), tuple(form)


def find_endings(heads: list[str | None], nums: list, sticky: list[int]) -> None:
    """Conclusion, appendix and so on, from the end back to the last sticky one, get positions from the end."""
    missing = set(ENDINGS)
    for s in sticky:
        missing -= {k for k, p in ENDINGS.items() if p.match(heads[s] or "")}
    new = []
    for i in range(len(heads) - 1, sticky[-1] if sticky else -1, -1):
        hit = {k for k, p in ENDINGS.items() if heads[i] is not None and p.match(heads[i])}
        if hit & missing:
            missing -= hit
            if nums[i] is None:
                nums[i] = (END - len(new),)
            new.append(i)
            if not missing:
                break
    sticky.extend(reversed(new))


def longest_chain(nums: list, forms: list | None, sticky: list[int], most: int = 3) -> list[int]:
    """Longest increasing chain whose steps are no sparser than `most`, through all sticky ones; [] if shorter than 2."""
    n = len(nums)
    best: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, -1, -1):
        best[i] = [i]
        need = [s for s in sticky if s >= i]
        for j in range(i + 1, n):
            if len(best[j]) >= len(best[i]) and follows(nums[i], nums[j], forms and forms[i], forms and forms[j], most):
                chain = [i, *best[j]]
                if set(need) <= set(chain):
                    best[i] = chain
    full = [c for c in best if set(sticky) <= set(c) and nums[c[0]] is not None]
    top = max(full, key=len, default=[])
    return top if len(top) > 1 else []


def fill_capitals(heads: list[str | None], nums: list, forms: list, chain: list[int]) -> None:
    """Where only top-level headlines are in capitals, unnumbered capitals take the numbers that are missing."""
    caps = lambda i: bool(heads[i]) and heads[i].isupper()
    own = [i for i in chain if nums[i] is not None]
    if not own or not any(len(nums[i]) > 1 for i in own) or not all(caps(i) == (len(nums[i]) == 1) for i in own):
        return
    for a, b in zip(chain, [*chain[1:], None], strict=True):
        lo = nums[a][0]
        hi = len(nums) + lo + 1 if b is None else nums[b][0]
        if lo > END // 2 or (b is not None and (hi > END // 2 or forms[a][0] != forms[b][0])):
            continue
        k = lo + 1
        for i in range(a + 1, len(nums) if b is None else b):
            if nums[i] is None and caps(i) and k < hi:
                nums[i], forms[i] = (k,), (forms[a][0],)
                k += 1


def repair_resets(nums: list, forms: list, sticky: list[int], level: int = 1) -> None:
    """Where sub-numbers start over below each number of `level`, they get their parent's number in front."""
    i = 0
    while i < len(nums):
        if nums[i] is None or len(nums[i]) != level or nums[i][-1] > END // 2:
            i += 1
            continue
        expected, j, inner = nums[i][:-1] + (nums[i][-1] + 1,), i + 1, []
        count = 1
        while j < len(nums) and nums[j] is not None and len(nums[j]) == level and j not in sticky and nums[j][:-1] == nums[i][:-1] and nums[j][-1] == count and nums[j] != expected:
            inner.append(j)
            count += 1
            j += 1
        rest = nums[j] if j < len(nums) else None
        if len(inner) > 1 and rest is not None and (rest == expected or rest[:-1] == nums[i][:-1] and rest[-1] == nums[i][-1] + 1):
            for k in inner:
                nums[k], forms[k] = nums[i] + nums[k][-1:], forms[i] + forms[k][-1:]
            repair_resets(nums, forms, sticky, level + 1) if level < 4 else None
        i = j if inner else i + 1


def numbers(heads: list[str | None]) -> tuple[list, list, list[int]]:
    """Serials, formats and sticky positions of sections."""
    got = [guess(h, True) for h in heads]
    nums, forms = [g and g[0] for g in got], [g[1] if g else (UNKNOWN,) for g in got]
    repair_roman(nums, forms)
    sticky = [i for i, h in enumerate(heads) if h is not None and nums[i] is not None and STICKY.match(h)]
    find_endings(heads, nums, sticky)
    fill_capitals(heads, nums, forms, longest_chain(nums, forms, sticky))
    repair_resets(nums, forms, sticky)
    return nums, forms, sticky


def _texts(section: dict) -> Iterator[dict]:
    """Leaves of a section, first to last."""
    c = section["content"]
    if isinstance(c, dict):
        yield section
    else:
        for x in c:
            yield from _texts(x)


def name_bare_numbers(sections: list[dict], chain: set[int]) -> None:
    """A headline that is nothing but an anchor's number takes the first text of its section."""
    for i, s in enumerate(sections):
        h = s["headline"]
        m = STRICT.search(h) if h else None
        if i in chain and m and m.span() == (0, len(h)):
            leaf = next(_texts(s), None)
            if leaf is not None and leaf["content"]["text"] and len(leaf["content"]["text"]) <= 200 and leaf is not s:
                s["headline"] = f"{h} {leaf['content']['text']}"
                leaf["content"] = []
                _drop(s, leaf)


def _drop(section: dict, gone: dict) -> None:
    if isinstance(section["content"], list):
        section["content"] = [x for x in section["content"] if x is not gone]
        for x in section["content"]:
            _drop(x, gone)


def split_merged(sections: list[dict], nums: list, forms: list) -> list[dict]:
    """`2 Methods 2.1 Data` becomes an empty section and its child, if the second number directly follows the first."""
    out = []
    for s, n, f in zip(sections, nums, forms, strict=True):
        h, cut = s["headline"], None
        if h and n is not None:
            first = STRICT.search(h)
            for m in LENIENT.finditer(h, first.end() if first else 0):
                g = guess(m["n"], True)
                if g and len(g[0]) > 1 and follows(n, g[0], f, g[1]):
                    cut = m.start("n")
                    break
        if cut:
            out += [{"headline": h[:cut].strip(), "content": []}, {"headline": h[cut:].strip(), "content": s["content"]}]
        else:
            out.append(s)
    return out


def merge_split(sections: list[dict], nums: list, chain: set[int]) -> list[dict]:
    """An empty anchor before an unnumbered section that isn't an anchor takes its headline and content."""
    out, i = [], 0
    while i < len(sections):
        s = sections[i]
        if i in chain and s["content"] == [] and i + 1 < len(sections) and i + 1 not in chain and nums[i + 1] is None and sections[i + 1]["headline"]:
            nxt = sections[i + 1]
            out.append({"headline": f"{s['headline']} {nxt['headline']}", "content": nxt["content"]})
            i += 2
        else:
            out.append(s)
            i += 1
    return out


def to_levels(tree: dict) -> tuple[bool, dict]:
    """(whether levels were found or the tree is shallow anyway, the tree)."""
    sections = tree["content"]
    if not isinstance(sections, list):
        return False, tree
    if len(sections) < 2 or sum(bool(s["headline"] and NUMBERED.search(s["headline"])) for s in sections) <= 1:
        return True, tree
    sections = json.loads(json.dumps(sections))
    heads = lambda: [s["headline"] for s in sections]
    nums, forms, sticky = numbers(heads())
    chain = longest_chain(nums, forms, sticky)
    if not chain:
        return False, tree
    name_bare_numbers(sections, set(chain))
    sections = split_merged(sections, nums, forms)
    nums, forms, sticky = numbers(heads())
    sections = merge_split(sections, nums, set(chain))
    nums, forms, sticky = numbers(heads())
    chain = longest_chain(nums, forms, sticky)
    if len(chain) <= 3:
        return False, tree
    anchors, open_, path, before = set(chain), [[]], [], None
    for i, s in enumerate(sections):
        if i in anchors:
            depth = len(nums[i])
            if before is not None and not formats_match(before, forms[i]):
                return False, tree
            before = forms[i]
            path = path[: depth - 1]
            if len(path) < depth - 1 or any(p != nums[i][: len(p)] for p in path):
                return False, tree
            path.append(nums[i])
            open_ = open_[:depth]
        open_[-1].append(s)
        if i in anchors:
            if isinstance(s["content"], dict):
                s["content"] = [{"headline": None, "content": s["content"]}]
            open_.append(s["content"])
    return True, {"headline": tree["headline"], "content": open_[0]}


def restructure(docs: DataFrame, discard: bool = False) -> DataFrame:
    """(doc_id, hierarchy, established) of documents with trees as JSON; failed ones stay as they were, or go."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, t in zip(b["doc_id"], b["hierarchy"], strict=True):
                ok, tree = to_levels(json.loads(t)) if t else (False, None)
                if ok or not discard:
                    rows.append((d, t if tree is None else json.dumps(tree, ensure_ascii=False), ok))
            yield pd.DataFrame(rows, columns=["doc_id", "hierarchy", "established"]).astype({"doc_id": "int64"})

    return docs.select("doc_id", "hierarchy").mapInPandas(run, "doc_id bigint, hierarchy string, established boolean")
