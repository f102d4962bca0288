"""Word lists and patterns that results depend on.

They are data, not logic, and have to stay exactly as they are for results to
be comparable between runs and engines.
"""

# --- sentiment and toxicity -------------------------------------------------
POSITIVE_WORDS = (
    "love", "great", "excellent", "awesome", "wonderful",
    "good", "happy", "fantastic", "amazing", "like",
)
NEGATIVE_WORDS = (
    "hate", "terrible", "bad", "awful", "horrible",
    "sad", "angry", "disappointing", "worst", "poor",
)
TOXIC_WORDS = (
    "hate", "stupid", "idiot", "dumb", "terrible",
    "horrible", "worst", "kill", "trash", "awful",
)
SENTIMENT_LABELS = {
    "NEGATIVE": "negative", "NEUTRAL": "neutral", "POSITIVE": "positive",
    "LABEL_0": "negative", "LABEL_1": "neutral", "LABEL_2": "positive",
}
TOXIC_LABELS = {
    "TOXIC": "toxic", "TOXICITY": "toxic", "1": "toxic", "LABEL_1": "toxic",
    "NON_TOXIC": "non_toxic", "NON-TOXIC": "non_toxic", "NOT_TOXIC": "non_toxic",
    "0": "non_toxic", "LABEL_0": "non_toxic",
}
TOXIC_SCORE_LABELS = ("TOXIC", "TOXICITY", "1")

# --- style ------------------------------------------------------------------
STYLE_HEDGES = (
    "might", "maybe", "perhaps", "possibly", "seems", "appears",
    "probably", "likely", "could", "would", "should", "allegedly",
    "supposedly", "presumably", "apparently", "potentially",
    "conceivably", "plausibly", "ostensibly",
)
SUPERLATIVES = (
    "best", "worst", "greatest", "largest", "smallest", "highest", "lowest",
    "most", "least", "ever", "never", "always", "completely", "totally",
    "absolutely", "extremely", "incredibly", "amazing", "terrible",
    "perfect", "horrible", "fantastic", "awful", "brilliant", "stupid",
    "genius", "disaster", "epic", "massive", "huge", "tiny",
)
EMOTION_WORDS = (
    "love", "hate", "angry", "furious", "excited", "thrilled",
    "disappointed", "frustrated", "happy", "sad", "scared",
    "worried", "concerned", "optimistic", "pessimistic", "hope",
    "fear", "joy", "rage", "disgust", "surprise", "trust",
)
QUESTION_WORDS = ("why", "what", "how", "when", "where", "who")
QUESTION_AUXILIARIES = ("is", "are", "do", "does", "did", "would", "should", "can", "could")
RHETORICAL_PHRASES = (
    "think about it", "let me be clear", "the fact is", "here's the thing",
    "don't you think", "wouldn't you agree", r"right\?",
    "obviously", "clearly", "undoubtedly", "without question",
)
THINKING_EMOJI = "🤔"
FORMAL_WORDS = (
    "furthermore", "moreover", "nevertheless", "consequently", "therefore", "thus",
    "pursuant", "regarding", "aforementioned", "heretofore", "whereas",
    "indicate", "demonstrate", "establish", "constitute", "implement",
)
INFORMAL_WORDS = (
    "gonna", "wanna", "gotta", "kinda", "sorta", "yeah", "ok", "okay",
    "awesome", "cool", "sucks", "crap", "damn", "hell",
)
EMOJI_RANGES = ((0x1F300, 0x1F64F), (0x1F680, 0x1F6FF), (0x1F1E0, 0x1F1FF))

# --- links ------------------------------------------------------------------
SOCIAL_DOMAINS = (
    "twitter.com", "x.com", "t.co", "facebook.com", "fb.com", "fb.me",
    "youtube.com", "youtu.be", "instagram.com", "linkedin.com", "tiktok.com",
    "reddit.com", "telegram.me", "t.me", "discord.gg", "snapchat.com",
    "pinterest.com", "tumblr.com",
)
NEWS_DOMAINS = (
    "cnn.com", "bbc.com", "reuters.com", "ap.org", "nytimes.com",
    "washingtonpost.com", "wsj.com", "theguardian.com", "dailymail.co.uk",
    "foxnews.com", "msnbc.com", "abc.go.com", "cbsnews.com", "nbcnews.com",
    "bloomberg.com", "ft.com", "economist.com", "politico.com", "thehill.com",
    "axios.com",
)
GOVERNMENT_SUFFIXES = ("gov", "mil", "edu")
# http(s) and www. forms take one character class from "!" and "$" to "_" plus
# letters; a bare host name has at most 127 labels (RFC 1035), and the bound
# keeps the JVM regex engine from recursing without limit.
HTTP_URL = r"https?://[!$-_a-zA-Z]+|www\.[!$-_a-zA-Z]+"
ANY_URL = (
    r"(?i)https?://[!$-_a-z]+|www\.[!$-_a-z]+"
    r"|(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.){1,127}[a-z]{2,}(?:/[^\s]*)?"
)

# --- entities ---------------------------------------------------------------
# surface form, canonical name, type
BUILT_IN_ENTITIES = (
    ("democrats", "Democratic Party", "ORG"),
    ("republicans", "Republican Party", "ORG"),
    ("dnc", "Democratic Party", "ORG"),
    ("twitter", "Twitter", "ORG"),
    ("united states", "United States", "LOC"),
)
CAPITALISED_STOP_WORDS = ("the", "and", "show")
ENTITY_GARBAGE = (
    "the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "an", "a",
    "anti", "pro", "non", "pre", "post", "de", "la", "el", "le", "les", "der", "die", "das",
    "rep", "sen", "mr", "mrs", "ms", "dr", "prof", "jr", "sr", "ii", "iii", "iv", "show",
)
PARTIAL_TOKENS = ("iden", "ka", "po", "se", "ch", "charlie", "de")
ENTITY_TYPES = {
    "PER": "PERSON", "PERSON": "PERSON", "ORG": "ORG", "ORGANIZATION": "ORG",
    "LOC": "LOC", "LOCATION": "LOC", "GPE": "LOC", "MISC": "MISC", "MISCELLANEOUS": "MISC",
}

# --- quotes -----------------------------------------------------------------
# name, pattern (Java, UNIX_LINES so that only \n ends a line), group 1 = text
QUOTE_PATTERNS = (
    ("double", r'"([^"]{10,})"'),
    ("single_smart", "‘([^’]{10,})’"),
    ("block", r"^>\s*(.+)$"),
    ("bar", r"^\|\s*(.+)$"),
    ("em_dash", "—\\s*(.+)$"),
    ("double_dash", r"--\s*(.+)$"),
    ("trailing_name", r"\n\s*-\s*([A-Z][^.!?]*[.!?])$"),
)
CURLY_DOUBLE = ("curly", "“([^”]{10,})”")
FORWARD_SOURCE = r"(?i)forwarded\s+from\s+(.+?)[:：]"
FORWARD_MARKERS = (r"forwarded\s+from\s+.+?[:：]", r"forwarded\s+message", r"fwd:\s*", r"re:\s*")
TWO_NAMES = r"[A-Z][a-z]+\s+[A-Z][a-z]+"
ONE_OR_TWO_NAMES = r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?"
# name, pattern with the speaker in group 1
SPEAKER_PATTERNS = (
    ("said", rf"({TWO_NAMES})\s+said[:\s]"),
    ("tweeted", rf"({TWO_NAMES})\s+tweeted[:\s]"),
    ("wrote", rf"({TWO_NAMES})\s+wrote[:\s]"),
    ("stated", rf"({TWO_NAMES})\s+stated[:\s]"),
    ("according_to", rf"according\s+to\s+({ONE_OR_TWO_NAMES})"),
    ("put_it", rf"as\s+({ONE_OR_TWO_NAMES})\s+put\s+it"),
)

# --- stance -----------------------------------------------------------------
SUPPORT_VERBS = (
    "support", "back", "endorse", "praise", "defend", "champion", "approve",
    "favor", "promote", "advocate", "celebrate", "love", "admire", "respect",
    "trust", "appreciate", "agree",
)
OPPOSE_VERBS = (
    "oppose", "criticize", "condemn", "attack", "denounce", "reject", "hate",
    "despise", "disapprove", "disagree", "fight", "resist", "protest", "slam",
    "blast", "destroy", "corrupt", "crooked",
)
STANCE_NEGATIONS = (
    "not", "never", "no", "don't", "doesn't", "won't", "can't",
    "shouldn't", "wouldn't", "isn't", "aren't", "wasn't", "weren't",
)
STANCE_HEDGES = (
    "might", "maybe", "perhaps", "possibly", "seems", "appears",
    "probably", "likely", "could", "would", "should",
)
STANCE_HYPOTHESES = {
    "support": "The author expresses support toward {}.",
    "oppose": "The author expresses opposition toward {}.",
    "neutral": "The author expresses neutral sentiment toward {}.",
}

# --- topics -----------------------------------------------------------------
ONTOLOGY = (
    ("immigration", ("immigration", "border", "migrants", "asylum", "refugee",
                     "deportation", "visa", "citizenship")),
    ("economy", ("jobs", "inflation", "economy", "economic", "unemployment", "GDP",
                 "market", "trade", "tariffs")),
    ("healthcare", ("healthcare", "medical", "insurance", "hospital", "doctor",
                    "medicine", "health", "pandemic", "covid")),
    ("education", ("education", "school", "university", "student", "teacher",
                   "learning", "curriculum", "academic")),
    ("climate", ("climate", "environment", "global warming", "carbon", "emissions",
                 "renewable", "energy", "pollution")),
    ("foreign_policy", ("foreign policy", "international", "diplomacy", "war", "peace",
                        "alliance", "sanctions", "treaty")),
    ("technology", ("technology", "tech", "AI", "artificial intelligence", "internet",
                    "social media", "cyber", "digital")),
    ("civil_rights", ("civil rights", "equality", "discrimination", "racism", "gender",
                      "LGBTQ", "freedom", "justice")),
    ("elections", ("election", "vote", "voting", "ballot", "campaign", "candidate",
                   "democracy", "poll")),
    ("crime_justice", ("crime", "justice", "police", "law enforcement", "prison",
                       "court", "legal", "criminal")),
)
DEFAULT_TOPIC_LABELS = (
    "politics and government", "elections and voting", "immigration and border security",
    "economy and finance", "healthcare and medical", "education and schools",
    "crime and law enforcement", "foreign policy and international relations",
    "military and defense", "civil rights and social justice", "environment and climate",
    "technology and innovation", "media and journalism", "religion and faith",
    "entertainment and culture", "sports and recreation", "business and industry",
    "science and research", "conspiracy theories and misinformation",
    "other news and current events",
)
ERROR_CATEGORIES = (
    "sarcasm_misfires", "nickname_failures", "quote_misattribution", "boundary_errors",
    "type_confusion", "stance_ambiguity", "context_dependency",
)
STAGES = (
    "data_loading", "language_detection", "quote_detection", "entity_extraction",
    "sentiment_analysis", "toxicity_detection", "stance_classification",
    "style_extraction", "topic_classification", "link_extraction",
)
