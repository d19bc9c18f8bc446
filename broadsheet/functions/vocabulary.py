"""Word lists and thresholds. All values here are fixed: results depend on them."""

from __future__ import annotations

# Words that never help to link an item to an article.
STOP_WORDS = (
    "about", "after", "again", "against", "also", "among", "and", "are",
    "because", "been", "before", "being", "between", "but", "can", "could",
    "did", "does", "for", "from", "had", "has", "have", "her", "his",
    "into", "its", "more", "new", "not", "over", "said", "that", "the",
    "their", "them", "they", "this", "through", "under", "was", "were",
    "will", "with", "would", "year", "years",
)

# Titles that are never articles.
BLOCKED_TITLES = ("market data", "financial times share service", "managed funds service", "what s news", "whats news")

# Categories and phrases of advertisements.
AD_CATEGORIES = ("advertisement", "advertising", "sponsored content", "paid post", "brand content")
AD_PHRASES = (
    "now at etrade",
    "check out etrade com",
    "call today for a free",
    "promotional offer",
    "terms and conditions apply",
    "paid advertisement",
    "terms conditions restrictions and capacity constraints",
    "mansionglobal com newsletters",
    "your new daily real estate obsession",
)

# Phrases of market tables and service pages.
SERVICE_PHRASES = ("market data", "financial times share service", "managed funds service", "share service", "funds service", "stock market data")

# The sections that each publication prints.
SECTIONS = {
    "WSJ": ("PAGE ONE", "U.S. NEWS", "WORLD NEWS", "OPINION", "SPORTS", "BUSINESS & FINANCE", "TECHNOLOGY", "PERSONAL JOURNAL", "ARTS IN REVIEW", "MARKETS DIGEST", "HEARD ON THE STREET", "EXCHANGE"),
    "TE": (
        "THE WORLD THIS WEEK", "LEADERS", "LETTERS", "BRIEFING", "UNITED STATES", "THE AMERICAS", "ASIA", "CHINA", "MIDDLE EAST & AFRICA",
        "EUROPE", "BRITAIN", "INTERNATIONAL", "BUSINESS", "FINANCE & ECONOMICS", "SCIENCE & TECHNOLOGY", "CULTURE", "OBITUARY",
    ),
    "BARRONS": (
        "UP & DOWN WALL STREET", "STREETWISE", "REVIEW & PREVIEW", "INCOME INVESTING", "FUNDS QUARTERLY", "THE ECONOMY", "TECH TRADER",
        "MARKET WEEK", "INTERNATIONAL TRADER", "THE STRIKING PRICE", "INSIDE SCOOP", "WINNERS & LOSERS", "MARKET VIEW", "OTHER VOICES",
        "RETIREMENT MAILBAG",
    ),
    "FT": ("NATIONAL", "INTERNATIONAL", "COMPANIES & MARKETS", "UK COMPANIES", "MARKETS", "OPINION", "LIFE & ARTS", "HOUSE & HOME", "MONEY", "FT WEEKEND"),
}

# What marks a promotion among a magazine's blocks, all of them together.
PODCAST_PROMOTION = ("in a weekly podcast by barron", "subscribe to barron", "favorite listening app")
# Phrases of promotions in large type.
HEADLINE_PROMOTIONS = ("daily real estate obsession", "mansionglobal com newsletters")

# The categories that others are mapped to, in order of precedence.
STANDARD_CATEGORIES = (
    "UP & DOWN WALL STREET", "STREETWISE", "REVIEW & PREVIEW",
    "INCOME INVESTING", "FUNDS QUARTERLY", "THE ECONOMY", "TECH TRADER",
    "MARKET WEEK", "INTERNATIONAL TRADER", "THE STRIKING PRICE",
    "INSIDE SCOOP", "WINNERS & LOSERS", "MARKET VIEW", "OTHER VOICES",
    "RETIREMENT MAILBAG",
    "U.S. NEWS", "WORLD NEWS", "PERSONAL JOURNAL", "SPORTS", "ARTS IN REVIEW",
    "OPINION", "BUSINESS & FINANCE", "TECHNOLOGY", "MARKETS DIGEST",
    "CLOSED-END FUNDS", "HEARD ON THE STREET", "NEW PRIME MINISTER",
    "INTERNATIONAL", "COMPANIES & MARKETS", "UK COMPANIES", "MARKET DATA",
    "FINANCIAL TIMES SHARE SERVICE", "MANAGED FUNDS SERVICE", "ARTS",
    "FT Big Read: Global Trade", "The FT View",
    "BUSINESS", "MARKETS", "EXCHANGE", "ANALYSIS", "REVIEW", "REVIEW & OUTLOOK",
    "NATIONAL", "LIFE & ARTS", "STYLE & FASHION", "ADVENTURE & TRAVEL",
    "EATING & DRINKING", "GEAR & GADGETS", "BOOKS", "CULTURE & ENTERTAINMENT",
    "TAX REPORT", "WELLNESS & BEAUTY", "SHORTCUTS: BUSINESS",
    "LETTERS TO THE EDITOR", "OBITUARY", "UK Politics / Economy",
    "Technology / Business", "House & Home", "Money", "FT Weekend",
    "FT Globetrotter", "Letters", "Property Gallery", "Online learning",
    "UK POLITICS", "GLOBAL", "ASIA", "CHINA", "EUROPE",
    "BRITAIN", "Leaders", "Briefing", "BUTTONWOOD", "FREE EXCHANGE",
    "THE AMERICAS", "MIDDLE EAST & AFRICA",
    "SCIENCE & TECHNOLOGY", "FINANCE & ECONOMICS", "CULTURE",
    "THE WORLD THIS WEEK", "BY INVITATION",
)

# Thresholds.
MIN_WORDS = 80
TEASER_WORDS = 120
FRAGMENT_OVERLAP = 0.65
CONTINUATION_OVERLAP = 0.75
FUZZY_TITLE = 0.72
FUZZY_LOOK_BACK = 20
DIRECTORY_COVERAGE = 0.65
DIRECTORY_ITEM = 0.6
DIRECTORY_TOKENS = 4
LINK_TITLE_WEIGHT = 7
LINK_THRESHOLD_LABELLED = 3
LINK_THRESHOLD_UNLABELLED = 14
COLUMN_DISTANCE = 32
PACK_WORDS = 90
