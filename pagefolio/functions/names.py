"""Client names from image addresses.

Two cleaners are in use. A takes the whole address and drops the first word of its last
segment; B takes the file name and puts it in title case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefolio.functions.text import BLANK, collapse_blanks, is_blank, let, strip

# Fixed values of cleaner A.
HEX_PREFIX = r"^(?:[0-9a-fA-F]+_)+"
EXTENSION = r"(?d)\.[^.]+$"
JOINERS = r"[_\-]+"
DROPPED_WORDS = (r"(?iuU)\blogo\b", r"(?iuU)\borig\b")
TRAILING_COUNT = r"(?dU)\(\d+\)$"
DROPPED_ICON = "noun circle arrow right up 2892975 FFFFFF"
LONG_CODE = rf"(?U)\d\d+[a-z0-9]+{BLANK}+"

# Fixed values of cleaner B.
SIZE_PART = r"(?U)[-_]\d+x\d+(-\d+)?"
NUMBER_PART = r"(?U)[-_]\d+"
IMAGE_EXTENSION = r"(?idu)\.(png|jpg|jpeg|webp)$"

# Runs of letters that have case, and runs of everything else.
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"
_CASE_RUNS = rf"[{_CASED}]+|[^{_CASED}]+"
# A capital sigma inside a word: letters follow, if need be after marks that do not end a word.
_INNER_SIGMA = rf"(?<=[{_CASED}])Σ(?=[\p{{Mn}}\p{{Me}}\p{{Cf}}\p{{Lm}}\p{{Sk}}'.:·’‘․‧]*[{_CASED}])"


def _drop(text: Column, *patterns: str) -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, "")
    return text


def url_decoded(text: Column) -> Column:
    """Percent-decode; ``+`` and broken escapes stay as they are."""
    safe = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))


def name_from_address(address: Column) -> Column:
    """Cleaner A. The result may have blanks at its ends."""
    bare = _drop(url_decoded(address), HEX_PREFIX, EXTENSION)
    words = strip(collapse_blanks(F.regexp_replace(bare, JOINERS, " ")))
    plain = strip(_drop(words, *DROPPED_WORDS, TRAILING_COUNT))
    segment = F.element_at(F.split(plain, "/"), -1)
    rest = F.regexp_replace(segment, r"\A[^ ]*( |\z)", "")
    shown = F.replace(F.replace(rest, F.lit("%20"), F.lit(" ")), F.lit(DROPPED_ICON), F.lit(""))
    return _drop(shown, LONG_CODE)


def title_case(text: Column) -> Column:
    """Capital after anything that is not a letter, small letters elsewhere."""
    inner = F.regexp_replace(text, _INNER_SIGMA, "σ")
    runs = F.regexp_extract_all(inner, F.lit(_CASE_RUNS), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def name_from_file(address: Column) -> Column:
    """Cleaner B."""
    file = F.element_at(F.split(address, "/"), -1)
    bare = _drop(file, SIZE_PART, NUMBER_PART, IMAGE_EXTENSION)
    return title_case(strip(F.regexp_replace(bare, JOINERS, " ")))


def client_name(address: Column, cleaner: Column) -> Column:
    """The cleaned name, or null where it is empty or there is no address to clean."""
    a = let(name_from_address(address), lambda a: F.when(~is_blank(a), a))
    b = let(name_from_file(F.coalesce(address, F.lit(""))), lambda b: F.when(b != "", b))
    return F.when(cleaner == "A", a).otherwise(b)
