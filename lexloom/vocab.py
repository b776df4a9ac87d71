"""Fixed vocabularies. Genre, length and level tables are inputs of the operators;
these are the values used when the caller brings none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# English stopwords left out of word and n-gram profiles.
STOPWORDS = (
    "a an the and or but in on at to for of is it this that was were be been "
    "being have has had do does did will would shall should may might can could "
    "not no nor so if then than too very just about above after again all also "
    "am any are as between both by down during each few from further get got he "
    "her here hers herself him himself his how i its itself let me more most my "
    "myself now off once only other our ours ourselves out over own re s same she "
    "some such t them themselves there these they their theirs through under "
    "until up us we what when where which while who whom why with you your yours "
    "yourself yourselves d ll m o ve"
).split()

# Text lengths and language levels, in rising order.
LENGTHS = ["very short", "short", "medium", "long", "very long"]
LEVELS = ["A2", "B1", "B2", "C1", "C2"]

# Genre names by category.
GENRES = {
    "Reference": ["encyclopedia entry", "academic abstract", "museum or exhibit label", "textbook explanation"],
    "Journalism": [
        "news article lede", "investigative journalism", "tabloid headline or lede", "op-ed / opinion column",
        "sports commentary", "letter to the editor",
    ],
    "Academic": [
        "empirical paper finding", "humanities paper argument", "peer review comment", "grant proposal excerpt",
        "ethnographic field note", "academic lecture transcript",
    ],
    "Personal": [
        "Reddit post", "personal blog post", "diary or journal entry", "oral history excerpt", "forum Q&A answer",
        "chat or SMS exchange", "podcast transcript excerpt",
    ],
    "Narrative": [
        "documentary narration", "biography excerpt", "myth or folklore retelling",
        "fantasy or sci-fi world-building", "song lyrics", "children's book passage", "film or TV synopsis",
    ],
    "Formal": [
        "legal or policy document", "press release", "diplomatic statement", "parliamentary debate",
        "court or legal testimony", "patent claim", "intelligence briefing memo", "financial report excerpt",
        "political manifesto excerpt", "sermon or religious address", "internal corporate memo",
        "incident or police report", "terms of service excerpt",
    ],
    "Promotional": [
        "advertisement copy", "real estate listing", "job posting", "crowdfunding pitch", "startup pitch",
        "dating profile", "business proposal",
    ],
    "Service": [
        "how-it-works explainer", "instruction manual step", "recipe", "FAQ entry", "medical patient leaflet",
        "technical README", "error message or system alert", "weather forecast", "travel guide entry",
        "self-help passage",
    ],
    "Cultural": [
        "social media thread", "product or book review", "customer complaint", "listicle entry", "speech excerpt",
        "letter or email", "satirical piece", "obituary", "eulogy", "stand-up comedy bit", "horoscope column",
        "auction catalog entry", "nature writing", "crisis communication statement",
    ],
    "Specialised": [
        "medical case report", "philosophical thought experiment", "therapy progress note",
        "code comment or docstring", "museum audio guide script", "personal recommendation letter",
    ],
    "Scalar": [
        "performance evaluation", "severity triage note", "maturity or readiness assessment",
        "confidence or certainty report", "emotional intensity narrative", "risk or threat assessment",
        "progress or phase update", "quality or grade description", "urgency communication",
        "commitment or conviction statement",
    ],
    "Email": [
        "email newsletter", "spam or phishing email", "corporate email thread", "automated notification email",
    ],
    "Sentiment": ["mixed or ambivalent review", "lukewarm or tepid endorsement", "sarcastic or ironic praise"],
    "Forum": [
        "technical hobbyist forum post", "religious or philosophical discussion post", "off-topic or meta-discussion",
    ],
    "Financial": ["market commentary or analysis", "financial news brief", "economic policy discussion"],
    "Tech/Biz": ["technology product news", "tech industry analysis"],
}

# The categories added by the latest batch.
NEW_CATEGORIES = ["Email", "Sentiment", "Forum", "Financial", "Tech/Biz"]


def genre_table(spark: SparkSession) -> DataFrame:
    """(position, name, category, description, is_new); descriptions are neutral stand-ins."""
    rows, position = [], 0
    for category, names in GENRES.items():
        for name in names:
            rows.append((position, name, category, f"A text in the register of: {name}.", category in NEW_CATEGORIES))
            position += 1
    return spark.createDataFrame(
        rows, "position int, name string, category string, description string, is_new boolean"
    )


def length_table(spark: SparkSession) -> DataFrame:
    rows = [(i, label, f"Each text must be {label}.") for i, label in enumerate(LENGTHS)]
    return spark.createDataFrame(rows, "position int, label string, instruction string")


def level_table(spark: SparkSession) -> DataFrame:
    rows = [(i, label, f"Write at CEFR level {label}.") for i, label in enumerate(LEVELS)]
    return spark.createDataFrame(rows, "position int, label string, instruction string")
