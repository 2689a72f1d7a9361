"""Word tokeniser of the corpus statistics (T1) and whitespace tokens."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, collapse_whitespace

# The Italian + English stopword set of the word statistics, in
# the reference's order (duplicates included; membership is what matters).
STOPWORDS = [
    'di', 'a', 'da', 'in', 'con', 'su', 'per', 'tra', 'fra', 'il', 'lo', 'la', 'i', 'gli', 'le',
    'un', 'uno', 'una', 'del', 'dello', 'della', 'dei', 'degli', 'delle', 'al', 'allo', 'alla',
    'ai', 'agli', 'alle', 'dal', 'dallo', 'dalla', 'dai', 'dagli', 'dalle', 'nel', 'nello', 'nella',
    'nei', 'negli', 'nelle', 'sul', 'sullo', 'sulla', 'sui', 'sugli', 'sulle', 'è', 'sono', 'sei',
    'siamo', 'siete', 'ho', 'hai', 'ha', 'abbiamo', 'avete', 'hanno', 'che', 'chi', 'cui', 'come',
    'quando', 'dove', 'perché', 'se', 'ma', 'però', 'anche', 'ancora', 'già', 'solo', 'molto',
    'poco', 'più', 'meno', 'bene', 'male', 'sempre', 'mai', 'oggi', 'ieri', 'domani', 'qui', 'qua',
    'là', 'lì', 'questo', 'quello', 'questi', 'quelli', 'questa', 'quella', 'queste', 'quelle',
    'the', 'a', 'an', 'and', 'or', 'but', 'in', 'on', 'at', 'to', 'for', 'of', 'with', 'by',
    'from', 'up', 'about', 'into', 'through', 'during', 'before', 'after', 'above', 'below',
    'between', 'among', 'is', 'was', 'are', 'were', 'be', 'been', 'being', 'have', 'has', 'had',
    'do', 'does', 'did', 'will', 'would', 'could', 'should', 'may', 'might', 'must', 'can',
    'this', 'that', 'these', 'those', 'i', 'me', 'my', 'myself', 'we', 'our', 'ours', 'ourselves',
    'you', 'your', 'yours', 'yourself', 'yourselves', 'he', 'him', 'his', 'himself', 'she', 'her',
    'hers', 'herself', 'it', 'its', 'itself', 'they', 'them', 'their', 'theirs', 'themselves',
    'what', 'which', 'who', 'whom', 'when', 'where', 'why', 'how', 'all', 'any', 'both', 'each',
    'few', 'more', 'most', 'other', 'some', 'such', 'no', 'nor', 'not', 'only', 'own', 'same',
    'so', 'than', 'too', 'very', 'just', 'now', 'here', 'there', 'then', 'once', 'again', 'also',
    'still', 'back', 'even', 'well', 'way', 'get', 'go', 'come', 'make', 'take', 'see', 'know',
    'think', 'say', 'tell', 'give', 'find', 'use', 'work', 'call', 'try', 'ask', 'need', 'feel',
    'become', 'leave', 'put', 'mean', 'keep', 'let', 'begin', 'seem', 'help', 'talk', 'turn',
    'start', 'might', 'show', 'hear', 'play', 'run', 'move', 'like', 'live', 'believe', 'hold',
    'bring', 'happen', 'write', 'provide', 'sit', 'stand', 'lose', 'pay', 'meet', 'include',
    'continue', 'set', 'learn', 'change', 'lead', 'understand', 'watch', 'follow', 'stop', 'create',
    'speak', 'read', 'allow', 'add', 'spend', 'grow', 'open', 'walk', 'win', 'offer', 'remember',
    'love', 'consider', 'appear', 'buy', 'wait', 'serve', 'die', 'send', 'expect', 'build', 'stay',
    'fall', 'cut', 'reach', 'kill', 'remain',
]
# Fixed value: the letters the tokeniser keeps (after lower-casing).
LETTERS = "a-zA-ZàèéìíîòóùúÀÈÉÌÍÎÒÓÙÚ"
MIN_WORD_LENGTH = 3


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def content_words(c, stopwords=None) -> Column:
    """Array of lower-cased letter words, stopwords and words < 3 chars removed."""
    # isin over > 10 literals is planned as a hash-set lookup (InSet).
    stop = sorted(set(stopwords or STOPWORDS))
    t = F.regexp_replace(F.lower(_c(c)), "[^" + LETTERS + SPACE + "]", " ")
    toks = F.split(collapse_whitespace(t), " ", -1)
    return F.filter(toks, lambda w: (F.length(w) >= MIN_WORD_LENGTH) & ~w.isin(*stop))


def whitespace_tokens(c) -> Column:
    """Case-sensitive whitespace tokens (Python ``str.split()``)."""
    toks = F.split(collapse_whitespace(c), " ", -1)
    return F.filter(toks, lambda w: F.length(w) > 0)
