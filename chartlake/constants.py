"""Dictionaries, bands and word lists that results depend on."""

# Market code -> country name.
COUNTRY_NAMES = {
    "ad": "Andorra", "ae": "United Arab Emirates", "ar": "Argentina", "at": "Austria", "au": "Australia",
    "be": "Belgium", "bg": "Bulgaria", "bo": "Bolivia", "br": "Brazil", "by": "Belarus",
    "ca": "Canada", "ch": "Switzerland", "cl": "Chile", "co": "Colombia", "cr": "Costa Rica",
    "cy": "Cyprus", "cz": "Czech Republic", "de": "Germany", "dk": "Denmark", "do": "Dominican Republic",
    "ec": "Ecuador", "ee": "Estonia", "eg": "Egypt", "es": "Spain", "fi": "Finland",
    "fr": "France", "gb": "United Kingdom", "global": "Global", "gr": "Greece", "gt": "Guatemala",
    "hk": "Hong Kong", "hn": "Honduras", "hu": "Hungary", "id": "Indonesia", "ie": "Ireland",
    "il": "Israel", "in": "India", "is": "Iceland", "it": "Italy", "jp": "Japan",
    "kr": "South Korea", "kz": "Kazakhstan", "lt": "Lithuania", "lu": "Luxembourg", "lv": "Latvia",
    "ma": "Morocco", "mx": "Mexico", "my": "Malaysia", "ng": "Nigeria", "ni": "Nicaragua",
    "nl": "Netherlands", "no": "Norway", "nz": "New Zealand", "pa": "Panama", "pe": "Peru",
    "ph": "Philippines", "pk": "Pakistan", "pl": "Poland", "pt": "Portugal", "py": "Paraguay",
    "ro": "Romania", "sa": "Saudi Arabia", "se": "Sweden", "sg": "Singapore", "sk": "Slovakia",
    "sv": "El Salvador", "th": "Thailand", "tr": "Turkey", "tw": "Taiwan", "ua": "Ukraine",
    "us": "United States", "uy": "Uruguay", "ve": "Venezuela", "vn": "Vietnam", "za": "South Africa",
}

ROLLUP_COUNTRY = "Global"

# What a missing attribute becomes.
DEFAULTS = {"artist_names": "Unknown Artist", "track_name": "Unknown Track", "label": "Independent"}
UNKNOWN_ARTIST = DEFAULTS["artist_names"]
UNKNOWN_TRACK = DEFAULTS["track_name"]

# Artist-as-label spellings -> label.
LABEL_REMAP = {
    "Taylor Swift": "Republic Records",
    "Lord Huron": "Republic Records",
    "Shubh": "Warner Music India",
    "Diljit Dosanjh": "Warner Music India",
    "Central Cee": "Columbia",
    "Arizona Zervas": "Columbia",
    "Olivia Rodrigo Ps": "Geffen",
    "The Weeknd/Lyric": "Xo / Republic Records",
}
LABEL_REMAP_INDIA = {
    "Ap Dhillon": "Republic Records",
    "Karan Aujla": "Rehaan Records",
    "Ritviz": "Sony Music Entertainment India Pvt. Ltd.",
}

# Country aliases used in questions.
COUNTRY_ALIASES = {
    "us": "United States",
    "usa": "United States",
    "u.s.": "United States",
    "u.s.a.": "United States",
    "uk": "United Kingdom",
    "u.k.": "United Kingdom",
    "uae": "United Arab Emirates",
}

# Fixed values: (upper bound of rank, label).
HIT_BANDS = ((10, "Global Hit"), (50, "Major Hit"), (100, "Popular Track"))
HIT_DEFAULT = "Charting Track"
HIT_CATEGORIES = ("Global Hit", "Major Hit")

# Fixed values: (upper bound of age in days, label).
AGE_BANDS = ((90, "New Release"), (365, "Recent Hit"), (1825, "Established"))
AGE_OLDEST = "Evergreen"
AGE_MISSING = "Unknown"

# Fixed values: (comparison, bound, label), first match wins.
MOVEMENT_V1 = ((">=", 50, "Strong Gainer"), (">", 0, "Gainer"), ("=", 0, "Stable"), ("<=", -50, "Strong Decliner"))
MOVEMENT_V1_DEFAULT = "Decliner"
MOVEMENT_V2 = ((">=", 50, "Strong Gainer"), (">=", 5, "Gainer"), (">=", -4, "Stable"), (">", -50, "Decliner"))
MOVEMENT_V2_DEFAULT = "Strong Decliner"
MOVEMENT_MISSING = "New Entry"

# Lower bounds of daily streams.
STREAM_TIERS_V1 = ((10_000_000, "Mega Hit"), (1_000_000, "Super Hit"), (100_000, "High Performer"))
STREAM_TIERS_V2 = ((5_000_000, "Mega Hit"), (500_000, "Super Hit"), (50_000, "High Performer"))
STREAM_DEFAULT = "Regular"

# Table -> keywords that point a question at it; earlier tables win.
TABLE_KEYWORDS = {
    "country_performance": ("country", "countries", "market", "nation"),
    "artist_performance": ("artist", "artists", "singer", "singers", "musician", "musicians"),
    "label_performance_enhanced": ("label", "records", "recordings"),
    "kpi_song": ("song", "track", "songs", "tracks"),
}
COUNT_KEYWORDS = ("how many", "total number of", "number of")
TREND_KEYWORDS = ("grew", "growth", "grow")
SUPERLATIVE_KEYWORDS = (
    "highest", "strongest", "most", "least", "lowest", "top", "best",
    "worst", "bottom", "fastest", "number one", "number 1",
)
ASCENDING_KEYWORDS = ("least", "lowest", "worst", "bottom")

GREETING_WORDS = ("hi", "hello", "hey", "yo", "sup")
THANKS_WORDS = ("thanks", "thank you", "thx", "ty", "cheers")
META_PHRASES = (
    "who are you", "what are you", "what can you do", "what do you do",
    "help me", "how does this work", "what can i ask",
)
FOLLOWUP_WORDS = (
    "it", "its", "it's", "that", "this", "those", "these", "they", "them",
    "their", "he", "she", "him", "her", "his",
)
FOLLOWUP_PHRASES = (
    "what about", "and what", "how about", "same for", "compared to that",
    "compared to it", "compared to them",
)
COMPARISON_WORDS = ("which", "who", "faster", "better", "higher", "more", "most", "grew", "growth")

MIN_ENTITY_LENGTH = 5
FUZZY_CUTOFF = 90
RRF_K = 60
TOP_K = 5
NO_MATCH_DISTANCE = 0.95
EMBED_DIM = 384
EMBED_BATCH = 64

REPLY_TTL_SECONDS = 900
# Budget kind -> (window in seconds, allowed amount in it).
USAGE_LIMITS = {"tokens": (24 * 60 * 60, 90_000), "requests": (60, 15)}

# The English stop words of a common full-text configuration.
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being below "
    "between both but by can did do does doing don down during each few for from further had has have "
    "having he her here hers herself him himself his how i if in into is it its itself just me more most "
    "my myself no nor not now of off on once only or other our ours ourselves out over own s same she "
    "should so some such t than that the their theirs them themselves then there these they this those "
    "through to too under until up very was we were what when where which while who whom why will with "
    "you your yours yourself yourselves"
).split()
