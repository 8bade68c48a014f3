"""URL scalars: normalising, resolving, splitting, and the predicates over paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.expr import any_of, first_case, lookup, strip

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)"

# Word lists of the programme-page predicates.
PROGRAMME_WORDS = ["bachelor", "bachelors", "undergraduate", "master", "masters", "graduate", "phd", "doctorate", "degree", "program", "programme"]
HUB_ENDINGS = ["/programs", "/programmes", "/degrees", "/courses", "/graduate-programs", "/undergraduate-programs", "/fields-of-study", "/academics"]
FOLLOW_WORDS = ["academics", "academic", "study", "studies", "program", "programs", "programme", "programmes", "degree", "degrees", "course", "courses", "graduate", "undergraduate", "postgraduate", "master", "masters", "bachelor", "bachelors", "phd", "doctorate", "school", "schools", "faculty", "faculties", "department", "departments", "college", "institute", "curriculum", "field", "fields", "discipline", "disciplines", "subject", "subjects"]
SKIP_WORDS = ["news", "event", "events", "calendar", "press", "media", "contact", "about", "history", "privacy", "terms", "cookies", "login", "signin", "register", "jobs", "careers", "vacancies", "giving", "donate", "alumni", "facebook", "twitter", "linkedin", "instagram", "youtube"]

#: Countries by the longest matching suffix of a host; a parameter of country().
COUNTRIES = {"ac.uk": "united_kingdom", "uk": "united_kingdom", "de": "germany", "fr": "france", "es": "spain", "it": "italy", "nl": "netherlands", "ch": "switzerland", "at": "austria", "au": "australia", "edu.au": "australia", "ca": "canada", "edu": "united_states"}
SOCIAL = {"facebook.com": "facebook", "instagram.com": "instagram", "linkedin.com": "linkedin", "youtube.com": "youtube", "twitter.com": "twitter", "x.com": "x", "tiktok.com": "tiktok", "weibo.com": "weibo"}


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def host(url: Column) -> Column:
    """The authority as written; empty for a URL without scheme."""
    return F.regexp_extract(url, _PARTS, 2)


def path(url: Column) -> Column:
    """The path as written, without query and fragment; for a relative reference, all before these."""
    absolute = url.rlike(_PARTS)
    return F.when(absolute, F.regexp_extract(url, _PARTS, 3)).otherwise(F.regexp_extract(url, r"^([^?#]*)", 1))


def normalise(url: Column) -> Column:
    """Scheme, authority and path, without slashes at the end, query and fragment; the case of letters stays."""
    return F.regexp_replace(F.concat(F.regexp_extract(url, _PARTS, 1), F.lit("://"), host(url), path(url)), "/+$", "")


def depth(url: Column) -> Column:
    """The number of non-empty path segments."""
    return F.size(F.filter(F.split(path(url), "/"), lambda s: s != "")).cast("int")


def resolve(base: Column, href: Column) -> Column:
    """href against base, without its fragment and slashes at either end.

    For absolute, protocol-relative, root-relative, query and plain relative references without dot segments; what has
    dot segments or an odd form is for html.resolve_any, a vectorised function around the standard library.
    """
    href = F.regexp_replace(strip(href), "#.*$", "")
    root = F.concat(F.regexp_extract(base, _PARTS, 1), F.lit("://"), host(base))
    folder = F.regexp_replace(path(base), "[^/]*$", "")
    full = first_case(
        [
            (href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href),
            (href.startswith("//"), F.concat(F.regexp_extract(base, _PARTS, 1), F.lit(":"), href)),
            (href.startswith("/"), F.concat(root, href)),
            (href == "", F.regexp_replace(base, "#.*$", "")),
            (href.startswith("?"), F.concat(root, path(base), href)),
        ],
        F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), href),
    )
    return F.regexp_replace(full, "^/+|/+$", "")


def looks_like_programme(url: Column, text: Column) -> Column:
    """A programme word in path or anchor text, no hub's ending, and two path segments or more."""
    where = F.lower(path(url))
    words = any_of(F.concat_ws(" ", where, strip(F.lower(text))), PROGRAMME_WORDS)
    hub = F.lit(False)
    for ending in HUB_ENDINGS:
        hub = hub | where.endswith(ending)
    return words & ~hub & (depth(url) >= 2)


def worth_following(url: Column, text: Column) -> Column:
    return any_of(F.lower(F.concat_ws(" ", url, text)), FOLLOW_WORDS)


def skipped(url: Column) -> Column:
    return any_of(F.lower(path(url)), SKIP_WORDS)


def profile_url(value: Column, base: str) -> Column:
    """Protocol-relative, root-relative and bare-domain forms as absolute https URLs; blank becomes null."""
    text = strip(value)
    return first_case([(text == "", F.lit(None).cast("string")), (text.startswith("//"), F.concat(F.lit("https:"), text)), (text.startswith("/"), F.concat(F.lit(base.rstrip("/")), text)), (text.rlike("^[a-z]+://"), text)], F.concat(F.lit("https://"), text))


def slug(url: Column) -> Column:
    """The last path segment in lower case."""
    return F.lower(F.element_at(F.split(F.regexp_replace(path(url), "/+$", ""), "/"), -1))


def slug_title(value: Column) -> Column:
    return F.initcap(F.regexp_replace(value, "[-_]+", " "))


def platform(url: Column) -> Column:
    """The social platform of a URL's host or its parent domain, else null."""
    name = F.regexp_replace(F.lower(host(url)), r"^(www|m)\.", "")
    return first_case([((name == domain) | name.endswith(f".{domain}"), F.lit(label)) for domain, label in SOCIAL.items()], F.lit(None).cast("string"))


def country(url: Column, suffixes: dict[str, str] | None = None) -> Column:
    """By the longest of a host's last two labels or last one in the table, else 'unknown'."""
    labels = F.split(F.lower(F.regexp_replace(host(url), ":[0-9]+$", "")), r"\.")
    table = suffixes or COUNTRIES
    last = F.element_at(labels, -1)
    two = F.when(F.size(labels) > 1, F.concat_ws(".", F.try_element_at(labels, F.lit(-2)), last))
    return F.coalesce(lookup(two, table, F.lit(None).cast("string")), lookup(last, table, F.lit("unknown")))
