"""Licence signature rules: hand-written patterns for licence families and texts.

A rule has a priority (smaller is tried first), a label, a pattern over the lower-cased bytes of a text, the keywords
that all must occur before the pattern is tried, and a confidence.  Families are crossed with the ways in which licences
are referred to; ``{s}`` stands for short runs of white space, quotes, comment marks and the like, ``{v}`` for what may
stand before a version.  Every alternative of a pattern is a rule of its own, and its keywords are the words that stand
in all its matches, taken from the pattern itself, so the keywords never keep back a match.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from itertools import pairwise

#: Label, how the licence is named (patterns over lower-cased text).
FAMILIES = [
    ("mit", r"(?:mit|expat)"), ("mit-0", r"mit{s}no{s}attribution"), ("x11", r"(?:x11|mit/x11)"),
    ("apache-1.1", r"apache(?:{s}software)?{v}1\.1"), ("apache-2.0", r"apache{v}2(?:\.0)?"), ("apache", r"apache(?:{s}software)?"),
    ("gpl-2.0", r"(?:gnu{s})?gpl{v}2(?:\.0)?"), ("gpl-3.0", r"(?:gnu{s})?gpl{v}3(?:\.0)?"), ("gpl", r"(?:gnu{s})?gpl"),
    ("lgpl-2.1", r"(?:gnu{s})?lgpl{v}2\.1"), ("lgpl-3.0", r"(?:gnu{s})?lgpl{v}3(?:\.0)?"), ("lgpl", r"(?:gnu{s})?lgpl"),
    ("agpl-3.0", r"(?:gnu{s})?agpl{v}3(?:\.0)?"), ("agpl", r"(?:gnu{s})?agpl"), ("gfdl", r"(?:gnu{s})?(?:gfdl|free{s}documentation)"),
    ("bsd-2-clause", r"(?:bsd{s}2{s}clause|2{s}clause{s}bsd|simplified{s}bsd|freebsd)"), ("bsd-3-clause", r"(?:bsd{s}3{s}clause|3{s}clause{s}bsd|new{s}bsd|modified{s}bsd)"),
    ("bsd-4-clause", r"(?:bsd{s}4{s}clause|4{s}clause{s}bsd|original{s}bsd)"), ("0bsd", r"(?:0bsd|zero{s}clause{s}bsd)"), ("bsd", r"bsd"),
    ("mpl-1.1", r"(?:mozilla{s}public|mpl){v}1\.1"), ("mpl-2.0", r"(?:mozilla{s}public|mpl){v}2(?:\.0)?"), ("mpl", r"(?:mozilla{s}public|mpl)"),
    ("epl-1.0", r"(?:eclipse{s}public|epl){v}1(?:\.0)?"), ("epl-2.0", r"(?:eclipse{s}public|epl){v}2(?:\.0)?"), ("epl", r"(?:eclipse{s}public|epl)"),
    ("cddl-1.0", r"(?:common{s}development{s}and{s}distribution|cddl)(?:{v}1(?:\.[01])?)?"), ("cpl-1.0", r"(?:common{s}public|cpl)(?:{v}1(?:\.0)?)?"),
    ("isc", r"isc"), ("zlib", r"zlib(?:/libpng)?"), ("libpng", r"libpng"), ("bsl-1.0", r"boost{s}software|bsl{v}1\.0"),
    ("artistic-1.0", r"artistic{v}1(?:\.0)?"), ("artistic-2.0", r"artistic{v}2(?:\.0)?"), ("artistic", r"(?:perl{s})?artistic"),
    ("eupl-1.2", r"(?:european{s}union{s}public|eupl)(?:{v}1\.[12])?"), ("osl-3.0", r"(?:open{s}software|osl)(?:{v}3(?:\.0)?)?"), ("afl-3.0", r"(?:academic{s}free|afl)(?:{v}3(?:\.0)?)?"),
    ("ms-pl", r"microsoft{s}public|ms{s}pl"), ("ms-rl", r"microsoft{s}reciprocal|ms{s}rl"), ("psf-2.0", r"(?:python{s}software{s}foundation|psf)(?:{v}2(?:\.0)?)?"),
    ("php-3.01", r"php(?:{v}3\.01)?"), ("ruby", r"ruby"), ("openssl", r"openssl"), ("curl", r"curl"), ("ncsa", r"(?:university{s}of{s}illinois/)?ncsa"),
    ("postgresql", r"postgresql"), ("unicode", r"unicode"), ("wtfpl", r"wtfpl|do{s}what{s}the{s}fuck{s}you{s}want{s}to{s}public"), ("ofl-1.1", r"(?:sil{s})?open{s}font|ofl(?:{v}1\.1)?"),
    ("odbl-1.0", r"open{s}database|odbl(?:{v}1\.0)?"), ("elastic-2.0", r"elastic(?:{v}2(?:\.0)?)?"), ("sspl-1.0", r"server{s}side{s}public|sspl"), ("busl-1.1", r"business{s}source|busl(?:{v}1\.1)?"),
]
#: Ways to refer to a licence (N is its name), confidence, priority.
FORMS = [
    (r"spdx{s}license{s}identifier{s}?:?{s}?N", 1.0, 10),
    (r"licensed{s}under{s}(?:the{s})?(?:terms{s}of{s}(?:the{s})?)?N(?:{s}licen[cs]e)?", 0.95, 20),
    (r"released{s}under{s}(?:the{s})?N{s}licen[cs]e", 0.95, 20),
    (r"distributed{s}under{s}(?:the{s})?(?:terms{s}of{s}(?:the{s})?)?N{s}licen[cs]e", 0.95, 20),
    (r"licen[cs]e{s}?[:=]{s}?N", 0.9, 30),
    (r"N{s}licen[cs]e(?:{v}\d(?:\.\d+)?)?", 0.8, 40),
]
#: Label, pattern, confidence, priority.  Names spelled out, addresses, and sentences of licence texts.
TEXTS = [
    ("gpl-2.0", r"gnu{s}general{s}public{s}licen[cs]e(?:{v}|{s}\(gpl\){v})2(?:\.0)?", 0.95, 15),
    ("gpl-3.0", r"gnu{s}general{s}public{s}licen[cs]e(?:{v}|{s}\(gpl\){v})3(?:\.0)?", 0.95, 15),
    ("gpl", r"(?:gnu{s})?general{s}public{s}licen[cs]e", 0.9, 35),
    ("lgpl", r"(?:gnu{s})?(?:lesser|library){s}general{s}public{s}licen[cs]e", 0.9, 14),
    ("agpl", r"(?:gnu{s})?affero{s}general{s}public{s}licen[cs]e", 0.9, 14),
    ("apache-2.0", r"apache{s}licen[cs]e{v}2(?:\.0)?", 0.95, 25),
    ("cc0-1.0", r"(?:creative{s}commons{s}(?:cc0|zero)|cc0(?:{v}1\.0)?)", 0.9, 20),
    ("public-domain", r"(?:released{s}into{s}|dedicated{s}to{s}|in{s})the{s}public{s}domain", 0.8, 30),
    ("unlicense", r"this{s}is{s}free{s}and{s}unencumbered{s}software|the{s}unlicense", 0.95, 15),
    ("mit", r"permission{s}is{s}hereby{s}granted,{s}free{s}of{s}charge,{s}to{s}any{s}person{s}obtaining{s}a{s}copy", 0.95, 15),
    ("isc", r"permission{s}to{s}use,{s}copy,{s}modify,{s}and(?:/or)?{s}distribute{s}this{s}software", 0.9, 15),
    ("bsd", r"redistribution{s}and{s}use{s}in{s}source{s}and{s}binary{s}forms", 0.9, 15),
    ("apache-2.0", r"www\.apache\.org/licenses/license-2\.0", 0.95, 10),
    ("gpl", r"www\.gnu\.org/licenses/(?:old-licenses/)?gpl", 0.9, 10),
    ("lgpl", r"www\.gnu\.org/licenses/(?:old-licenses/)?lgpl", 0.9, 10),
    ("agpl", r"www\.gnu\.org/licenses/agpl", 0.9, 10),
    ("mit", r"opensource\.org/licen[cs]es?/mit", 0.95, 10),
    ("mpl-2.0", r"mozilla\.org/mpl/2\.0", 0.95, 10),
    ("all-rights-reserved", r"all{s}rights{s}reserved", 0.5, 60),
    ("proprietary", r"proprietary{s}and{s}confidential", 0.6, 60),
    ("unknown-licence", r"(?:licensed|released|distributed){s}under", 0.3, 90),
]
CC_PARTS = ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

_SPACE, _VERSION = r"[\s\"'*#/(),:;_-]{1,6}", r"(?:[\s\"'*#/(),:;-]{0,6}(?:version|v\.?|-)?[\s-]{0,3})"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    priority: int
    label: str
    pattern: re.Pattern
    keywords: tuple[bytes, ...]
    confidence: float


def _rule(n: int, priority: int, label: str, pattern: str, keywords: tuple[str, ...], confidence: float) -> Rule:
    full = pattern.replace("{s}?", f"(?:{_SPACE})?").replace("{s}", _SPACE).replace("{v}", _VERSION)
    return Rule(f"r{n:03d}-{label}", priority, label, re.compile(rf"(?<![0-9a-z\x80-\xff])(?:{full})(?![0-9a-z\x80-\xff])".encode("latin-1")), tuple(k.encode() for k in keywords), confidence)


def _top(pattern: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The parts between bars outside of groups, and the places of the outermost groups' brackets."""
    depth, start, bars, groups = 0, 0, [-1], []
    for m in re.finditer(r"\\.|[()|]", pattern):
        if m.group() == "(":
            start, depth = (m.start() if not depth else start), depth + 1
        elif m.group() == ")":
            depth -= 1
            if not depth:
                groups.append((start, m.start()))
        elif m.group() == "|" and not depth:
            bars.append(m.start())
    return [pattern[a + 1 : b] for a, b in pairwise([*bars, len(pattern)])], groups


def _alternatives(pattern: str) -> list[str]:
    """The pattern once for each choice between its alternatives; optional groups stay as they are."""
    parts, groups = _top(pattern)
    if len(parts) > 1:
        return [x for p in parts for x in _alternatives(p)]
    for start, end in groups:
        choices = _alternatives(pattern[start + 3 : end])
        if len(choices) > 1 and pattern[end + 1 : end + 2] != "?":
            return [x for c in choices for x in _alternatives(pattern[:start] + c + pattern[end + 1 :])]
    return [pattern]


def _needs(pattern: str) -> tuple[str, ...]:
    """Words of two letters or more that stand in every match of a pattern without alternatives, longest first."""
    p, before = re.sub(r"\{s\}\??|\{v\}|\\.[?*+]?|\[[^\]]*\][?*+]?", " ", pattern), None
    while p != before:
        before, p = p, re.sub(r"\(\?:([^()]*)\)(\??)", lambda m: " " if m[2] or "|" in m[1] else m[1], p, count=1)
    return tuple(sorted(set(re.findall(r"[0-9a-z]{2,}", re.sub(r"[0-9a-z][?*]", " ", p))), key=lambda w: (len(w), w), reverse=True))


@cache
def _specs() -> tuple[tuple[int, str, str, tuple[str, ...], float], ...]:
    """(priority, label, pattern, keywords, confidence) in the order in which they are tried: priority, then the longer pattern."""
    named = [(label, name.replace("{v}", "(?:{s}licen[cs]e)?{v}")) for label, name in FAMILIES]  # Apache 2.0, Apache License 2.0
    whole = [(priority + (label in ("apache", "gpl", "lgpl", "agpl", "bsd", "mpl", "epl", "artistic")), label, form.replace("N", f"(?:{name})"), confidence)
             for label, name in named for form, confidence, priority in FORMS]
    whole += [(priority, label, pattern, confidence) for label, pattern, confidence, priority in TEXTS]
    for parts in CC_PARTS:
        name = parts.replace("-", "{s}")
        for who in ("cc", "creative{s}commons"):
            whole += [(12, f"cc-{parts}-{v}", f"{who}{{s}}{name}{{v}}{re.escape(v)}", 0.95) for v in CC_VERSIONS]
            whole.append((22, f"cc-{parts}", f"{who}{{s}}{name}", 0.85))
        whole.append((12, f"cc-{parts}", rf"creativecommons\.org/licenses/{parts}/", 0.95))
    specs = dict.fromkeys((priority, label, x, _needs(x), confidence) for priority, label, pattern, confidence in whole for x in _alternatives(pattern))
    return tuple(sorted(specs, key=lambda s: (s[0], -len(s[2]), s[1], s[2])))


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in the order in which they are tried."""
    return tuple(_rule(n, *s) for n, s in enumerate(_specs()))


#: Every match holds one of these, a keyword of its rule; texts without any aren't looked at further.
TRIGGERS = tuple(sorted({"licen" if any("licen" in k for k in keywords) else keywords[0] for *_, keywords, _ in _specs()}))
