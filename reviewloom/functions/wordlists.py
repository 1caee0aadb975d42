"""Word lists and patterns.

Everything in this module is a fixed value: results depend on these exact words.
"""

from __future__ import annotations

# Contraction -> expansion, replaced in this order.
CONTRACTIONS = {
    "won't": "will not", "wouldn't": "would not", "couldn't": "could not",
    "shouldn't": "should not", "haven't": "have not", "hasn't": "has not",
    "hadn't": "had not", "doesn't": "does not", "didn't": "did not",
    "don't": "do not", "isn't": "is not", "aren't": "are not",
    "wasn't": "was not", "weren't": "were not", "can't": "cannot",
    "i'm": "i am", "you're": "you are", "he's": "he is", "she's": "she is",
    "it's": "it is", "we're": "we are", "they're": "they are",
    "i've": "i have", "you've": "you have", "we've": "we have",
    "they've": "they have", "i'd": "i would", "you'd": "you would",
    "he'd": "he would", "she'd": "she would", "we'd": "we would",
    "they'd": "they would", "i'll": "i will", "you'll": "you will",
    "he'll": "he will", "she'll": "she will", "we'll": "we will",
    "they'll": "they will", "let's": "let us", "that's": "that is",
    "who's": "who is", "what's": "what is", "here's": "here is",
    "there's": "there is", "where's": "where is", "when's": "when is",
    "why's": "why is", "how's": "how is",
}

# Words that open a negation scope.
NEGATIONS = (
    "not", "no", "nor", "neither", "never", "none", "nobody", "nothing", "nowhere",
)

# The published word lists of the valence rules, for negation and for more and less of a degree.
VALENCE_NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
    "ain't", "aren't", "can't", "couldn't", "daren't", "didn't", "doesn't",
    "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither",
    "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't",
    "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing",
    "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't", "without",
    "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom", "despite",
)
MORE_WORDS = (
    "absolutely", "amazingly", "awfully", "completely", "considerable",
    "considerably", "decidedly", "deeply", "effing", "enormous", "enormously",
    "entirely", "especially", "exceptional", "exceptionally", "extreme",
    "extremely", "fabulously", "flipping", "flippin", "frackin", "fracking",
    "fricking", "frickin", "frigging", "friggin", "fully", "fuckin", "fucking",
    "fuggin", "fugging", "greatly", "hella", "highly", "hugely", "incredible",
    "incredibly", "intensely", "major", "majorly", "more", "most",
    "particularly", "purely", "quite", "really", "remarkably", "so",
    "substantially", "thoroughly", "total", "totally", "tremendous",
    "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly",
    "very",
)
LESS_WORDS = (
    "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little",
    "marginal", "marginally", "occasional", "occasionally", "partly", "scarce",
    "scarcely", "slight", "slightly", "somewhat", "sorta", "sortof", "sort-of",
)
DOUBT_WORDS = ("doubt",)

# Stop words that are kept because they carry polarity.
KEPT_STOP_WORDS = ("not", "no", "nor", "neither", "never", "none")

# Sentiment words counted on cleaned text.
POSITIVE_CLEANED = (
    "excellent", "perfect", "amazing", "wonderful", "fantastic", "great",
    "love", "best", "awesome", "incredible", "outstanding", "superb",
    "brilliant", "beautiful", "gorgeous", "fabulous", "magnificent",
)
NEGATIVE_CLEANED = (
    "terrible", "awful", "horrible", "bad", "poor", "worst", "hate",
    "disgusting", "disappointed", "useless", "waste", "broken", "defective",
    "unacceptable", "pathetic", "ridiculous", "garbage", "trash",
)

# Sentiment words counted on raw text.
POSITIVE_RAW = (
    "excellent", "perfect", "love", "wonderful", "amazing", "good", "great",
    "fantastic", "happy", "awesome", "best", "beautiful", "nice", "super",
)
NEGATIVE_RAW = (
    "bad", "terrible", "awful", "horrible", "hate", "worst", "poor",
    "disappointing", "useless", "broken", "failed", "sucks", "disgusting",
)

# Words that make a review urgent, and words about customer service.
URGENT_WORDS = ("urgent", "immediately", "asap", "terrible", "worst", "scam", "fraud")
SERVICE_WORDS = ("response", "service", "support", "help")
HIGH_VALUE_CATEGORIES = ("Electronics", "Home & Kitchen")

# The English stop words that ship with Spark ML's StopWordsRemover.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now i'll you'll
    he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
    how's let's ought that's there's what's when's where's who's why's would
    """.split()
)

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
