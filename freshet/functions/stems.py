"""English stems by suffix rules (the second Porter stemmer), as expressions over a column ``w``.

Each step is one expression that Spark and other engines understand alike, but for the
name of the regular-expression test, which the caller gives. Steps build on each other,
so they are applied one after the other, to distinct words. ``stem_of`` takes the same steps
for one word inside a task; a test compares both.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

V, C = "[aeiouy]", "[^aeiouy]"  # a consonant y is written Y in between
R1_WORDS = "^(gener|commun|arsen)"

# The rules of the algorithm. Irregular words, and words that keep their form.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
}
INVARIANT = ("sky", "news", "howe", "atlas", "cosmos", "bias", "andes")
INVARIANT_AFTER_PLURAL = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
# Suffixes of steps 2, 3 and 4, and what takes their place.
STEP_2 = {
    "ational": "ate", "fulness": "ful", "iveness": "ive", "ization": "ize", "ousness": "ous", "biliti": "ble", "lessli": "less", "tional": "tion",
    "alism": "al", "aliti": "al", "ation": "ate", "entli": "ent", "fulli": "ful", "iviti": "ive", "ousli": "ous", "abli": "able", "alli": "al",
    "anci": "ance", "ator": "ate", "enci": "ence", "izer": "ize", "bli": "ble",
}
STEP_3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ness": "", "ful": ""}
STEP_4 = ("ement", "able", "ance", "ence", "ible", "ment", "ant", "ate", "ent", "ism", "iti", "ive", "ize", "ous", "al", "er", "ic")


def _before(suffix: str) -> str:
    return f"left(w, length(w) - {len(suffix)})"


class _Rules:
    def __init__(self, has: str):
        self.has = has

    def test(self, x: str, pattern: str) -> str:
        return f"{self.has}({x}, '{pattern}')"

    def in_r1(self, x: str) -> str:
        """Is the first part of a word long enough that what follows lies in R1?"""
        return f"({self.test(x, R1_WORDS)} OR (NOT {self.test('w', R1_WORDS)} AND {self.test(x, V + C)}))"

    def in_r2(self, x: str) -> str:
        after = f"{self.test(x, R1_WORDS + '.*' + V + C)}"
        return f"({after} OR (NOT {self.test('w', R1_WORDS)} AND {self.test(x, V + C + '.*' + V + C)}))"

    def short_end(self, x: str) -> str:
        return self.test(x, f"{C}{V}[^aeiouywxY]$|^{V}{C}$")

    def replaced(self, suffix: str, by: str, condition: str) -> str:
        return f"WHEN w LIKE '%{suffix}' THEN CASE WHEN {condition} THEN concat({_before(suffix)}, '{by}') ELSE w END"

    def irregular(self) -> str:
        words = " ".join(f"WHEN w = '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
        return f"CASE {words} ELSE w END"

    def whole(self) -> str:
        """Words that no step may change end in a sign that no suffix has."""
        kept = ", ".join(f"'{x}'" for x in (*INVARIANT, *IRREGULAR.values()))
        return f"CASE WHEN length(w) <= 2 OR w IN ({kept}) OR NOT {self.test('w', '^[a-z]+$')} THEN concat(w, '!') ELSE w END"

    def plural(self) -> str:
        return f"""CASE WHEN w LIKE '%sses' THEN left(w, length(w) - 2)
            WHEN w LIKE '%ied' OR w LIKE '%ies' THEN CASE WHEN length(w) > 4 THEN left(w, length(w) - 2) ELSE left(w, length(w) - 1) END
            WHEN w LIKE '%us' OR w LIKE '%ss' THEN w
            WHEN w LIKE '%s' AND {self.test('w', V + '.+s$')} THEN left(w, length(w) - 1) ELSE w END"""

    def kept_after_plural(self) -> str:
        kept = ", ".join(f"'{x}'" for x in INVARIANT_AFTER_PLURAL)
        return f"CASE WHEN w IN ({kept}) THEN concat(w, '!') ELSE w END"

    def past(self) -> str:
        """Without -ed and -ing; a sign at the end says that the ending has to be mended."""
        cut = " ".join(
            f"WHEN w LIKE '%{s}' THEN CASE WHEN {self.test(_before(s), V)} THEN concat({_before(s)}, '+') ELSE w END" for s in ("ingly", "edly", "ing", "ed")
        )
        stay = " ".join(f"WHEN w LIKE '%{s}' THEN CASE WHEN {self.in_r1(_before(s))} THEN concat({_before(s)}, 'ee') ELSE w END" for s in ("eedly", "eed"))
        return f"CASE {stay} {cut} ELSE w END"

    def mended(self) -> str:
        bare = "left(w, length(w) - 1)"
        lone = f"NOT ({self.test(bare, R1_WORDS + '.')} OR {self.test(bare, V + C + '.')})"
        short = f"({lone} AND {self.short_end(bare)})"
        return f"""CASE WHEN w NOT LIKE '%+' THEN w WHEN {self.test(bare, '(at|bl|iz)$')} OR {short} THEN concat({bare}, 'e')
            WHEN {self.test(bare, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$')} THEN left(w, length(w) - 2) ELSE {bare} END"""

    def y_to_i(self) -> str:
        return f"CASE WHEN {self.test('w', '.' + C + '[yY]$')} THEN concat(left(w, length(w) - 1), 'i') ELSE w END"

    def step_2(self) -> str:
        by_length = sorted(STEP_2, key=len, reverse=True)
        rules = [self.replaced(s, STEP_2[s], self.in_r1(_before(s))) for s in by_length]
        rules.append(self.replaced("ogi", "og", f"{self.in_r1(_before('ogi'))} AND w LIKE '%logi'"))
        rules.append(self.replaced("li", "", f"{self.in_r1(_before('li'))} AND {self.test('w', '[cdeghkmnrt]li$')}"))
        return f"CASE {' '.join(rules)} ELSE w END"

    def step_3(self) -> str:
        rules = [self.replaced(s, STEP_3[s], self.in_r1(_before(s))) for s in sorted(STEP_3, key=len, reverse=True)]
        rules.insert(2, self.replaced("ative", "", self.in_r2(_before("ative"))))
        return f"CASE {' '.join(rules)} ELSE w END"

    def step_4(self) -> str:
        rules = [self.replaced(s, "", self.in_r2(_before(s))) for s in STEP_4]
        rules.append(self.replaced("ion", "", f"{self.in_r2(_before('ion'))} AND {self.test('w', '[st]ion$')}"))
        return f"CASE {' '.join(rules)} ELSE w END"

    def last_letter(self) -> str:
        bare = _before("e")
        return f"""CASE WHEN w LIKE '%e' THEN CASE WHEN {self.in_r2(bare)} OR ({self.in_r1(bare)} AND NOT {self.short_end(bare)}) THEN {bare} ELSE w END
            WHEN w LIKE '%ll' AND {self.in_r2(bare)} THEN {bare} ELSE w END"""


def stem_steps(has: str) -> list[str]:
    """The steps over ``w``, a lower-case word; ``has`` names the regular-expression test of the engine."""
    r = _Rules(has)
    marked = [r.irregular(), r.whole(), "CASE WHEN w LIKE 'y%' THEN concat('Y', substr(w, 2)) ELSE w END"]
    # y after a vowel is a consonant; in a row of y every other one is.
    for vowel in "aeiouy":
        marked.append(f"replace(w, '{vowel}y', '{vowel}Y')")
    steps = [r.plural(), r.kept_after_plural(), r.past(), r.mended(), r.y_to_i(), r.step_2(), r.step_3(), r.step_4(), r.last_letter()]
    return marked + steps + ["lower(replace(w, '!', ''))"]


def with_stems(words: DataFrame, word: str = "token", stem: str = "stem") -> DataFrame:
    """``words`` with the stem of each lower-case word; words of other signs than a to z are their own stem."""
    out = words.withColumn("w", F.col(word))
    for step in stem_steps("regexp"):
        out = out.withColumn("w", F.expr(step))
    return out.withColumnRenamed("w", stem)


def stem_sql(table: str, word: str = "token") -> str:
    """A query with every column of ``table`` and ``w``, the stem of ``word``, by the same steps."""
    out = f"SELECT *, {word} AS w FROM {table}"
    for step in stem_steps("regexp_matches"):
        out = f"SELECT * REPLACE ({step} AS w) FROM ({out})"
    return out


_LETTERS, _VOWEL = re.compile("[a-z]+"), re.compile(V)
_R1_WORDS, _R1 = re.compile(R1_WORDS), re.compile(V + C)
_R2_WORDS, _R2 = re.compile(R1_WORDS + ".*" + V + C), re.compile(V + C + ".*" + V + C)
_SHORT_END, _PLURAL = re.compile(f"{C}{V}[^aeiouywxY]$|^{V}{C}$"), re.compile(V + ".+s$")
_Y_END, _LONG = re.compile("." + C + "[yY]$"), re.compile(f"{R1_WORDS}.|{V}{C}.")
_KEPT = {*INVARIANT, *IRREGULAR.values()}
_BY_LENGTH = [tuple((x, d.get(x)) for x in sorted(d, key=len, reverse=True)) for d in (STEP_2, STEP_3)]
_STEP_3 = (*_BY_LENGTH[1][:2], ("ative", ""), *_BY_LENGTH[1][2:])


def _in_r1(w: str, x: str) -> bool:
    return bool(_R1_WORDS.search(x) or (not _R1_WORDS.search(w) and _R1.search(x)))


def _in_r2(w: str, x: str) -> bool:
    return bool(_R2_WORDS.search(x) or (not _R1_WORDS.search(w) and _R2.search(x)))


def _past(w: str) -> str:
    for suffix in ("eedly", "eed"):
        if w.endswith(suffix):
            bare = w[: -len(suffix)]
            return bare + "ee" if _in_r1(w, bare) else w
    for suffix in ("ingly", "edly", "ing", "ed"):
        if w.endswith(suffix):
            bare = w[: -len(suffix)]
            if not _VOWEL.search(bare):
                return w
            if bare.endswith(("at", "bl", "iz")) or (not _LONG.search(bare) and _SHORT_END.search(bare)):
                return bare + "e"
            return bare[:-1] if bare.endswith(("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")) else bare
    return w


def _step_2(w: str) -> str:
    for suffix, by in _BY_LENGTH[0]:
        if w.endswith(suffix):
            return w[: -len(suffix)] + by if _in_r1(w, w[: -len(suffix)]) else w
    if w.endswith("ogi"):
        return w[:-1] if w.endswith("logi") and _in_r1(w, w[:-3]) else w
    return w[:-2] if w.endswith("li") and w[-3:-2] in tuple("cdeghkmnrt") and _in_r1(w, w[:-2]) else w


def _step_3(w: str) -> str:
    for suffix, by in _STEP_3:
        if w.endswith(suffix):
            bare = w[: -len(suffix)]
            return bare + by if (_in_r2 if suffix == "ative" else _in_r1)(w, bare) else w
    return w


def _step_4(w: str) -> str:
    for suffix in STEP_4:
        if w.endswith(suffix):
            return w[: -len(suffix)] if _in_r2(w, w[: -len(suffix)]) else w
    return w[:-3] if w.endswith(("sion", "tion")) and _in_r2(w, w[:-3]) else w


def stem_of(word: str) -> str:
    """The stem of a lower-case word, as ``with_stems`` gives it."""
    w = IRREGULAR.get(word, word)
    if len(w) <= 2 or w in _KEPT or not _LETTERS.fullmatch(w):
        return w.lower()
    if "y" in w:
        w = "Y" + w[1:] if w[0] == "y" else w
        for vowel in "aeiouy":
            w = w.replace(vowel + "y", vowel + "Y")
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and _PLURAL.search(w):
        w = w[:-1]
    if w in INVARIANT_AFTER_PLURAL:
        return w.lower()
    w = _past(w)
    if w.endswith(("y", "Y")) and _Y_END.search(w):
        w = w[:-1] + "i"
    w = _step_4(_step_3(_step_2(w)))
    bare = w[:-1]
    if w.endswith("e"):
        w = bare if _in_r2(w, bare) or (_in_r1(w, bare) and not _SHORT_END.search(bare)) else w
    elif w.endswith("ll") and _in_r2(w, bare):
        w = bare
    return w.lower()
