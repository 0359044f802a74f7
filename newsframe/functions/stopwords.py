"""Stop-word lists for the body scorer.

English ships with the package. The other lists are Spark ML's defaults
(``StopWordsRemover.loadDefaultStopWords``), read from the spark-mllib jar. A language
without a list is an error: scoring with no words would keep no text block at
all. Languages outside the table (Spark ships none for ``vi``) take a
caller-supplied list.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile

# ISO 639-1 code -> Spark ML stop-word list name.
LANGUAGE_LISTS = {
    "da": "danish", "nl": "dutch", "en": "english", "fi": "finnish",
    "fr": "french", "de": "german", "hu": "hungarian", "it": "italian",
    "no": "norwegian", "pt": "portuguese", "ru": "russian", "es": "spanish",
    "sv": "swedish", "tr": "turkish",
}


# Spark ML's English list.
ENGLISH = """
a about above after again against all am an and any are aren't as at be because been before being
below between both but by can can't cannot could couldn't did didn't do does doesn't doing don don't
down during each few for from further had hadn't has hasn't have haven't having he he'd he'll he's
her here here's hers herself him himself his how how's i i'd i'll i'm i've if in into is isn't it
it's its itself just let's me more most mustn't my myself no nor not now of off on once only or
other ought our ours ourselves out over own s same shan't she she'd she'll she's should shouldn't so
some such t than that that's the their theirs them themselves then there there's these they they'd
they'll they're they've this those through to too under until up very was wasn't we we'd we'll we're
we've were weren't what what's when when's where where's which while who who's whom why why's will
with won't would wouldn't you you'd you'll you're you've your yours yourself yourselves
""".split()


class NoStopWords(LookupError):
    """No list for a language, and none given."""


@functools.lru_cache(maxsize=None)
def stop_words(language: str) -> tuple[str, ...]:
    """Lower-cased stop words of a language code (``en``) or list name."""
    name = LANGUAGE_LISTS.get(language, language)
    if name == "english":
        return tuple(ENGLISH)
    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars",
                                  "spark-mllib_*.jar"))
    for jar in jars:
        with zipfile.ZipFile(jar) as z:
            member = "org/apache/spark/ml/feature/stopwords/%s.txt" % name
            if member in z.namelist():
                words = z.read(member).decode("utf-8").split("\n")
                return tuple(sorted({w.strip().lower() for w in words if w.strip()}))
    raise NoStopWords(f"no stop words for {language!r}; pass stop_words=[...]")


def has_stop_words(language: str) -> bool:
    try:
        return bool(stop_words(language))
    except NoStopWords:
        return False
