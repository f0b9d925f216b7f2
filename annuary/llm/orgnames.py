"""Organisation names as people type them, taken apart into stem, kind words and town."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

#: Kind words of organisations and the abbreviations seen for them.
KIND_WORDS = {
    "college": ["college", "col", "coll"],
    "university": ["university", "univ", "u", "univy", "universitat", "universite"],
    "institute": ["institute", "inst", "institut", "instn", "institution"],
    "technology": ["technology", "technol", "techn", "tech"],
    "technische": ["technische"],
    "hochschule": ["hochschule", "hochsch"],
    "polytechnic": ["polytechnic", "polytech", "poly"],
    "agricultural": ["agricultural", "agric", "agr", "agricult"],
    "experiment": ["experiment", "exp", "exper", "expt"],
    "station": ["station", "sta", "stn"],
    "normal": ["normal", "norm", "nor"],
    "school": ["school", "sch"],
    "medical": ["medical", "med"],
    "chemical": ["chemical", "chem"],
    "electric": ["electric", "elec", "elect"],
    "company": ["company", "co", "compy", "comp", "corp"],
    "research": ["research", "res"],
    "laboratory": ["laboratory", "lab", "laby", "labs"],
    "foundation": ["foundation", "found", "fdn", "foundn"],
    "academy": ["academy", "acad"],
    "sciences": ["sciences", "sci", "science"],
    "geological": ["geological", "geol"],
    "survey": ["survey", "surv"],
    "museum": ["museum", "mus"],
    "natural": ["natural", "nat"],
    "history": ["history", "hist"],
    "botanical": ["botanical", "bot", "botan"],
    "garden": ["garden", "gard", "gdn", "gardens", "gdns"],
    "bureau": ["bureau", "bur"],
    "standards": ["standards", "stds", "stand", "std"],
    "hospital": ["hospital", "hosp"],
    "observatory": ["observatory", "obs", "observ", "obsy"],
    "seminary": ["seminary", "sem"],
    "state": ["state", "st"],
}
#: Words before a name that belong to it, and their abbreviations.
PREFIX_WORDS = {"north": ["north", "n", "no"], "south": ["south", "s", "so"], "east": ["east", "e"], "west": ["west", "w"], "mount": ["mount", "mt"], "saint": ["saint"], "fort": ["fort", "ft"]}
#: Words that carry nothing.
EMPTY_WORDS = {"of", "de", "the", "and", "for", "du", "la", "der", "in", "at"}
#: Entries that name no organisation.
NO_ORGANISATION = {
    "abroad", "business", "private practice", "ranching", "various companies", "various", "several", "unknown", "none", "farming",
    "travel", "retired", "at home", "home", "private business", "consulting practice", "practice", "independent", "not given", "see notes",
    "n a", "various places", "various firms", "private work", "government service", "war service", "army", "navy", "self", "freelance",
}
#: Entries in place of a town that name none.
NO_PLACE = {"unknown", "several", "various places", "various", "see notes", "n a", "none", "at sea"}
#: Last words of phrases that describe an occupation instead of an organisation.
OCCUPATION_ENDS = {"practice", "work", "companies", "firms", "business", "ranching", "farming", "travel", "study", "abroad", "war", "places", "consulting", "publishing", "mining", "teaching", "lecturing", "writing", "research"}

_KIND = {short: word for word, shorts in KIND_WORDS.items() for short in shorts}
_PREFIX = {short: word for word, shorts in PREFIX_WORDS.items() for short in shorts}
_TOKEN = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Lower case without accents and apostrophes, white space collapsed."""
    flat = text
    if not text.isascii():
        flat = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    flat = flat.lower()
    return re.sub(r"\s+", " ", re.sub(r"['’`]", "", flat)).strip()


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance by bit-parallel columns."""
    return 0 if a == b else distance_from(a)(b)


def distance_from(a: str) -> Callable[[str], int]:
    """The Levenshtein distance from a, for many comparisons with one text."""
    if not a:
        return len
    full, last, length = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    get = where.get

    def to(b: str) -> int:
        up, down, score = full, 0, length
        for c in b:
            eq = get(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph, mh = down | ~(xh | up) & full, up & xh
            if ph & last:
                score += 1
            elif mh & last:
                score -= 1
            ph = (ph << 1 | 1) & full
            up, down = (mh << 1 & full) | ~(xv | ph) & full, ph & xv
        return score

    return to


@lru_cache(maxsize=100_000)
def _close_kind(token: str) -> str | None:
    """The kind word that a misspelt token stands for, if it is long enough to tell."""
    if len(token) < 5:
        return None
    limit = 1 if len(token) < 8 else 2
    best = min(((edit_distance(token, w), w) for w in KIND_WORDS if abs(len(w) - len(token)) <= limit), default=None)
    return best[1] if best and best[0] <= limit else None


def _stop_after(word: str, text: str) -> bool:
    """Whether the word stands in the text with a full stop right after it."""
    at = text.find(word + ".")
    while at > 0 and (text[at - 1].isalnum() or text[at - 1] == "_"):
        at = text.find(word + ".", at + 1)
    return at >= 0


@dataclass(frozen=True)
class OrgName:
    stem: str  # name words, directions spelt out
    kind: str  # kind words in alphabetical order
    town: str  # what follows the name in a segment of its own
    cut: bool  # the stem is an abbreviation that ends in a full stop
    initials: str  # letters, when the whole string is an abbreviation such as K.S.C.
    of: bool = False  # 'University of X', which need not be 'X University'


def parse(text: str | None) -> OrgName | None:
    """Parts of a typed name; None if it is null, blank or names no organisation."""
    if text is None:
        return None
    flat = fold(text)
    words = _TOKEN.findall(flat)
    if not words or " ".join(words) in NO_ORGANISATION:
        return None
    if words[-1] in OCCUPATION_ENDS and all(w.isalpha() for w in words) and text.strip(" .")[-1:].islower() and not any(w in _KIND for w in words[:-1]) and (len(words) > 1 or words[0] != "research") and "," not in text:
        return None
    squeezed = re.sub(r"[\s.]", "", text)
    if re.fullmatch(r"[A-Z]{2,6}", squeezed) and (len(words) == 1 or all(len(w) == 1 for w in words)):
        return OrgName("", "", "", False, squeezed.lower())
    kinds: set[str] = set()
    names: list[tuple[list[str], bool]] = []
    for segment in re.split(r"[,;|]", flat):
        here: list[str] = []
        cut = False
        found = [re.sub(r"(?<=[a-z])1|1(?=[a-z])", "l", w) for w in _TOKEN.findall(segment)]
        for i, w in enumerate(found):
            if w in EMPTY_WORDS:
                continue
            if w == "st" and i + 1 < len(found) and not here and found[i + 1] not in _KIND:
                here.append("saint")
            elif w in _PREFIX and i + 1 < len(found) and not here:
                here.append(_PREFIX[w])
            elif w in _KIND:
                kinds.add(_KIND[w])
            elif (k := _close_kind(w)) is not None:
                kinds.add(k)
            else:
                here.append(w)
                # A full stop inside the string ends an abbreviation; the last one may just end the string.
                cut = _stop_after(w, segment) and (len(w) < 8 or not flat.endswith(f"{w}."))
        if any(w not in PREFIX_WORDS for w in here):
            names.append((here, cut))
    if "technische" in kinds or "hochschule" in kinds:
        kinds = (kinds - {"technology", "technische"}) | {"technische", "hochschule"}
    if not names:
        return OrgName("", " ".join(sorted(kinds)), "", False, "")
    stem, cut = names[0]
    town = " ".join(names[1][0]) if len(names) > 1 else ""
    of = "university" in kinds and re.search(r"\b(univ\w*|u)\b\.?,? (of|de)\b", flat) is not None
    return OrgName(" ".join(stem), " ".join(sorted(kinds)), town, cut, "", of)
