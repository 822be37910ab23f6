"""Problem 3: spellings of names that mean one person.

Method: block by phonetic codes of sorted tokens, compare with Jaro-Winkler plus the nickname table, cluster accepted
pairs by connected components.

1. Every spelling is parsed into tokens and roles (given name, father, family; titles, by-names, "son of" words, order
   and script resolved). Spellings with the same parts are one form; only forms are compared.
2. Phonetic codes are consonant skeletons that Arabic and Latin spellings share (long vowels, ayn and hamza dropped,
   emphatic and plain letters folded). A form's blocks are the sorted codes of two of its tokens: given name and family,
   father and family; the first also with any one code letter left out, so that a slip never separates two forms.
3. Jaro-Winkler compares the whole names, nicknames replaced by their given name, and accepts from MIN_JW on. An exact
   check follows: relatives differ by little, so each part may be one typing error apart, different names of the table
   are different, and fathers must not disagree. A given name occurs once in a family, so the father may be missing.
4. Accepted pairs are clustered. Forms that give only initials join the one cluster of the family that fits; if several
   fit, era and place of residence decide; if still several, they stay alone.

Scale: comparisons are among distinct forms of one block. Spellings of a frequent poet collapse into few forms before
the join, and forms with the same known given name and family never meet pair by pair: they link to their smallest.

Defined results: null, blank or nobody's names form no cluster; equal spellings on several rows are one person; extra
columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata as ud

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qafila.llm.unify import MARKS, consistent
from qafila.operators.components import components
from qafila.runtime import cut

#: The least similarity of two spellings of one person.
MIN_JW = 0.84
#: given_names is a reference table; a larger one is refused, not cut.
MAX_LEXICON = 100_000

# Titles, "son/daughter of", and credits that name nobody.
TITLES = {"الشاعر", "الشاعره", "الشيخ", "الشيخه", "الاستاذ", "الاستاذه", "الدكتور", "الدكتوره", "السيد", "السيده", "الامام", "القاضي", "الحاج", "dr", "mr", "mrs", "ms", "prof", "sheikh", "shaykh", "sheik", "poet", "the", "ustadh"}
CHILD_OF = {"بن", "ابن", "بنت", "ابنه", "ibn", "bin", "bint", "b", "ben", "ب"}
NOBODY = {"مجهول", "شاعر مجهول", "غير معروف", "بدون اسم", "لا يعرف قايله", "لا يعرف قائله", "unknown", "anonymous", "n/a", "na", "—", "-", "anon"}

_FOLD = str.maketrans({"أ": "ا", "إ": "ا", "آ": "ا", "ٱ": "ا", "ى": "ي", "ة": "ه", "ؤ": "و", "ئ": "ي", "ء": None})
# Latin letters and letter pairs of the usual transliteration.
_PAIRS = {"th": "ث", "dh": "ذ", "kh": "خ", "gh": "غ", "sh": "ش"}
_SINGLE = {"b": "ب", "t": "ت", "j": "ج", "ḥ": "ح", "d": "د", "r": "ر", "z": "ز", "s": "س", "ṣ": "ص", "ḍ": "ض", "ṭ": "ط", "ẓ": "ظ", "f": "ف", "q": "ق", "k": "ك", "l": "ل", "m": "م", "n": "ن", "h": "ه", "g": "ج", "p": "ب", "v": "ف", "c": "ك", "x": "ك"}
_EMPHATIC = str.maketrans("حصضطظثذ", "هسدتزسد")


def fold(s: str) -> str:
    """Arabic letters that writers exchange folded together, case and marks gone."""
    return MARKS.sub("", s).translate(_FOLD).lower()


def skeleton(token: str) -> str:
    """The consonants of a folded token in Arabic letters, without the article; the same for both scripts."""
    token = re.sub("^ال(?=...)", "", token)
    if token and token[0].isascii() or re.search("[a-zḥṣḍṭẓ]", token):
        out, i = [], 0
        token = token.replace("'", "").replace("-", "")
        while i < len(token):
            if token[i : i + 2] in _PAIRS:
                out.append(_PAIRS[token[i : i + 2]])
                i += 2
            else:
                out.append(_SINGLE.get(token[i], ""))
                i += 1
        return "".join(out)
    return re.sub("[اويعء]", "", token)


def phonetic(token: str) -> str:
    """Skeleton with emphatic letters as their plain ones."""
    return skeleton(token).translate(_EMPHATIC)


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken = [False] * len(b)
    hits = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    m, other = len(hits), [c for c, t in zip(b, taken, strict=True) if t]
    swapped = sum(x != y for x, y in zip(hits, other, strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return jaro + same * 0.1 * (1 - jaro)


def one_slip(a: str, b: str) -> bool:
    """Equal, or apart by one letter added, left out, exchanged, or by two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    ra, rb = a[i:], b[i:]
    return ra[1:] == rb or ra == rb[1:] or ra[1:] == rb[1:] or (len(ra) > 1 and len(rb) > 1 and ra[0] == rb[1] and ra[1] == rb[0] and ra[2:] == rb[2:])


class Lexicon:
    """Given names in both scripts and their nicknames, folded, with the first letter as written."""

    def __init__(self, rows: list[tuple[str, str, str]]) -> None:
        self.given: dict[str, str] = {}
        self.nick: dict[str, str] = {}
        self.first: dict[str, tuple[str, str]] = {}
        for name, latin, nickname in rows:
            key = fold(name).replace(" ", "")
            self.given[key] = key
            self.first[key] = (name[0], (latin or " ")[0].lower())
            if latin:
                self.given[fold(latin)] = key
            if nickname:
                self.nick[fold(nickname)] = key

    def by_name(self, tokens: list[str]) -> tuple[str | None, int]:
        """The given name the nickname at the head of the tokens stands for, and its length."""
        for n in (2, 1):
            if len(tokens) >= n and " ".join(tokens[:n]) in self.nick:
                return self.nick[" ".join(tokens[:n])], n
        return None, 0


PARTS = ["given", "given_known", "given_first", "father", "father_known", "father_first", "family", "script"]
_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))*\.?")
_NOBODY = {fold(x) for x in NOBODY}


def _bare(t: str) -> str:
    return fold(t.rstrip("."))


def _is_initial(t: str) -> bool:
    return t.endswith(".") and len(t) <= 3


def _article(t: str) -> bool:
    return (fold(t).startswith("ال") and len(t) > 4) or t.startswith("al-")


def parse(name: str | None, lexicon: Lexicon) -> dict | None:
    """The parts of a name; a given name or father of one letter is an initial, as written."""
    text = consistent(name)
    if not text or fold(text) in _NOBODY or not any(c.isalpha() for c in text):
        return None
    text = re.sub(r"\bعبد (?=\w)", "عبد", MARKS.sub("", text).lower().replace("،", ","))
    head, comma, rest = text.partition(",")
    tokens, family = (_TOKEN.findall(rest), _TOKEN.findall(head)) if comma else (_TOKEN.findall(head), [])
    while tokens and _bare(tokens[0]) in TITLES:
        tokens.pop(0)
    while family and _bare(family[0]) in TITLES:
        family.pop(0)
    if not family and tokens:
        turned = len(tokens) > 1 and _article(tokens[0]) and not _article(tokens[-1]) and _bare(tokens[0]) not in lexicon.given
        family, tokens = (tokens[:1], tokens[1:]) if turned else (tokens[-1:], tokens[:-1])
    if not family:
        return None
    # "د." before a written-out name is a title, before nothing but the family an initial
    if len(tokens) > 1 and tokens[0] in ("د.", "أ.", "ا.") and not _is_initial(tokens[1]):
        tokens.pop(0)
    called, used = lexicon.by_name([_bare(t) for t in tokens])
    tokens = tokens[used:]
    plain = [t for i, t in enumerate(tokens) if not (_bare(t) in CHILD_OF and i < len(tokens) - 1 and (i or called))]
    if called:
        if plain and not _is_initial(plain[0]) and (lexicon.given.get(_bare(plain[0])) == called or one_slip(_bare(plain[0]), called)):
            plain[0] = called
        else:
            plain.insert(0, called)

    def part(i: int) -> tuple[str, bool, str]:
        if len(plain) <= i:
            return "", False, ""
        if _is_initial(plain[i]):
            return plain[i][0], False, plain[i][0]
        token = _bare(plain[i])
        known = lexicon.given.get(token)
        return known or token, known is not None, lexicon.first[known][script == "latin"] if known else plain[i][0]

    fam = _bare(family[-1])
    script = "latin" if re.search("[a-z]", ud.normalize("NFKD", fam)) else "arabic"
    return dict(zip(PARTS, (*part(0), *part(1), re.sub("^al-", "", fam), script), strict=True))


def _one_left_out(code: str) -> list[str]:
    return sorted({code, *(code[:i] + code[i + 1 :] for i in range(len(code)))})


def block_keys(p: dict) -> list[str]:
    """Sorted phonetic codes of given name and family, and of father and family. Each code also with any one letter left
    out, so that a slip in one of the two never parts two forms; the codes are those of both scripts."""
    if len(p["given"]) < 2:
        return []
    family, given = phonetic(p["family"]), phonetic(p["given"])
    pairs = {(given, x) for x in _one_left_out(family)} | {(x, family) for x in _one_left_out(given)}
    if len(p["father"]) > 1:
        pairs.add((phonetic(p["father"]), family))
    return sorted({"|".join(sorted(pair)) for pair in pairs})


def compared(a: dict, b: dict) -> tuple[str, str]:
    """What Jaro-Winkler compares: family without article, given name by the nickname table, father if both tell him.

    Between scripts the family counts by its phonetic code; given names are the table's own in both.
    """
    fathers = len(a["father"]) > 1 and len(b["father"]) > 1
    family = (lambda f: re.sub("^ال(?=...)", "", f)) if a["script"] == b["script"] else phonetic
    return tuple(" ".join([family(p["family"]), p["given"], *([p["father"]] if fathers else [])]) for p in (a, b))


def _same_part(a: str, a_known: bool, b: str, b_known: bool) -> bool:
    """One typing error at most; two different names of the table are no slips of each other."""
    return a == b or (not (a_known and b_known) and one_slip(a, b))


def same_person(a: dict, b: dict) -> bool:
    """Whether two written-out forms mean one person.

    Jaro-Winkler over the whole name decides (MIN_JW); an exact check follows, as namesakes of a family differ by little:
    each part at most one typing error apart and at most two of the three parts, no initial against another name.
    """
    if jaro_winkler(*compared(a, b)) < MIN_JW:
        return False
    if a["script"] == b["script"]:
        family = one_slip(a["family"], b["family"])
    else:
        family = phonetic(a["family"]) == phonetic(b["family"]) and (skeleton(a["family"]) == skeleton(b["family"]) or a["family"].isascii() or b["family"].isascii())
    if not (family and _same_part(a["given"], a["given_known"], b["given"], b["given_known"])):
        return False
    slips = (a["family"] != b["family"] and a["script"] == b["script"]) + (a["given"] != b["given"])
    if len(a["father"]) > 1 and len(b["father"]) > 1:
        slips += a["father"] != b["father"]
        return slips <= 2 and _same_part(a["father"], a["father_known"], b["father"], b["father_known"])
    return not (a["father"] and b["father"] and a["script"] == b["script"] and a["father_first"] != b["father_first"])


_FORM = T.StructType([T.StructField(k, T.BooleanType() if k.endswith("_known") else T.StringType()) for k in PARTS] + [T.StructField("keys", T.ArrayType(T.StringType()))])


def load_lexicon(given_names: DataFrame) -> Lexicon:
    rows = given_names.select("given_name", "latin_form", "nickname").filter("given_name is not null").limit(MAX_LEXICON + 1).collect()
    if len(rows) > MAX_LEXICON:
        raise ValueError(f"more than {MAX_LEXICON} given names")
    return Lexicon([tuple(r) for r in rows])


def link_names(names: DataFrame, given_names: DataFrame) -> DataFrame:
    """name_id, person_id: the smallest name_id among all spellings of the person."""
    lexicon = load_lexicon(given_names)

    @F.pandas_udf(_FORM)
    def parts(values: pd.Series) -> pd.DataFrame:
        rows = []
        for v in values:
            p = parse(v, lexicon)
            rows.append({**p, "keys": block_keys(p)} if p else dict.fromkeys([*PARTS, "keys"]))
        return pd.DataFrame(rows, columns=[*PARTS, "keys"])

    parsed = cut(
        names.select("name_id", "poet_name", "poet_era", "poet_location")
        .filter("name_id is not null")
        .withColumn("p", parts("poet_name"))
        .select("name_id", "poet_era", "poet_location", "p.*")
        .filter("family is not null")
    )
    forms = cut(parsed.groupBy(*PARTS).agg(F.min("name_id").alias("form_id"), F.first("keys").alias("keys")))
    whole = forms.filter(F.length("given") > 1)
    pairs = _accepted(whole)
    clusters = components(pairs.unionByName(whole.select(F.col("form_id").alias("a"), F.col("form_id").alias("b"))))
    clusters = cut(whole.join(clusters.withColumnRenamed("node", "form_id"), "form_id"))
    rows = parsed.join(forms.select("form_id", *PARTS), PARTS)
    people = _initials(rows, clusters)
    by_form = rows.filter(F.length("given") > 1).join(clusters.select("form_id", "component"), "form_id").select("name_id", "component")
    linked = by_form.unionByName(people)
    # components are named by the smallest form, whose id is the smallest name_id of it; initials may hold a smaller one
    first = linked.groupBy("component").agg(F.min("name_id").alias("person_id"))
    return linked.join(first, "component").select("name_id", "person_id")


def _accepted(forms: DataFrame) -> DataFrame:
    """a, b: forms of one block that mean one person."""
    known = forms.filter("given_known").select("given", "family", "script", "form_id")
    head = cut(known.groupBy("given", "family", "script").agg(F.min("form_id").alias("a")))
    # known given name and equal family: one person, linked to the smallest form
    exact = known.join(head, ["given", "family", "script"]).filter("a < form_id").select("a", F.col("form_id").alias("b"))
    # of forms with known given name and equal family those with different fathers are kept: fathers decide some slips
    kept = forms.join(head.select(F.col("a").alias("form_id"), F.lit(True).alias("head")), "form_id", "left").filter("head or not given_known or length(father) > 1")
    blocks = kept.select("form_id", F.explode("keys").alias("key"), F.struct(*PARTS).alias("p"))
    x, y = blocks.alias("x"), blocks.alias("y")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.form_id") < F.col("y.form_id")))
    pairs = pairs.select(F.col("x.form_id").alias("a"), F.col("y.form_id").alias("b"), F.col("x.p").alias("pa"), F.col("y.p").alias("pb")).dropDuplicates(["a", "b"])

    def parts(side: pd.DataFrame):
        return (dict(zip(PARTS, row, strict=True)) for row in zip(*(side[c].tolist() for c in PARTS), strict=True))

    @F.pandas_udf(T.BooleanType())
    def accept(pa: pd.DataFrame, pb: pd.DataFrame) -> pd.Series:
        return pd.Series(list(map(same_person, parts(pa), parts(pb))), dtype=bool)

    return exact.unionByName(pairs.filter(accept("pa", "pb")).select("a", "b"))


def _place(c):
    """Place names with or without the article are one place."""
    return F.regexp_replace(c, r"(^| )ال", "$1")


def _initials(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """name_id, component for spellings that give only initials (see 4. above)."""
    short = rows.filter(F.length("given") <= 1)
    facts = (
        rows.join(clusters.select("form_id", "component"), "form_id")
        .groupBy("component")
        .agg(F.collect_set("poet_era").alias("eras"), F.collect_set(_place(F.col("poet_location"))).alias("places"))
    )
    known = (
        clusters.filter("given_known")
        .groupBy("component", "family", "script", F.col("given_first").alias("g1"))
        .agg(F.collect_set(F.when(F.length("father") > 0, F.col("father_first"))).alias("fathers"))
        .join(facts, "component")
    )
    short = short.select("name_id", "family", "script", F.col("given_first").alias("sg"), F.col("father_first").alias("sf"), F.col("poet_era").alias("se"), _place(F.col("poet_location")).alias("sl"))
    fits = short.join(known, ["family", "script"]).filter(
        ((F.col("sg") == "") | (F.col("sg") == F.col("g1")) | ((F.col("sg") == "ا") & F.col("g1").isin("أ", "إ", "آ")))
        & ((F.col("sf") == "") | (F.size("fathers") == 0) | F.array_contains("fathers", F.col("sf")) | (F.col("sf") == "ا"))
    )
    by_era = F.when(F.col("se").isNull() | (F.size("eras") == 0), F.lit(1)).when(F.array_contains("eras", F.col("se")), F.lit(2)).otherwise(F.lit(0))
    by_place = F.when(F.col("sl").isNull() | (F.size("places") == 0), F.lit(1)).when(F.array_contains("places", F.col("sl")), F.lit(2)).otherwise(F.lit(0))
    scored = fits.select("name_id", "component", F.when((by_era == 0) | (by_place == 0), F.lit(0)).otherwise(by_era * by_place).alias("score"))
    best = scored.groupBy("name_id").agg(F.max("score").alias("top"), F.count("*").alias("n"), F.max_by("component", "score").alias("component"), F.collect_list("score").alias("all"))
    # one fitting cluster needs no context; of several the best must be alone
    sure = best.filter((F.col("n") == 1) | ((F.col("top") > 0) & (F.size(F.filter("all", lambda s: s == F.col("top"))) == 1)))
    chosen = sure.select("name_id", "component")
    alone = short.select("name_id").join(chosen.select("name_id"), "name_id", "left_anti").select("name_id", F.col("name_id").alias("component"))
    return chosen.unionByName(alone)


def same_person_pairs(names: DataFrame, given_names: DataFrame) -> DataFrame:
    """name_id_a < name_id_b of every two rows that mean one person, through the classes of link_names."""
    linked = cut(link_names(names, given_names))
    x = linked.select("person_id", F.col("name_id").alias("name_id_a"))
    y = linked.select("person_id", F.col("name_id").alias("name_id_b"))
    return x.join(y, "person_id").filter("name_id_a < name_id_b").select("name_id_a", "name_id_b")
