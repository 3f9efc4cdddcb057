"""Fixed values. They decide results, so they are stated plainly in one place.

Word lists, unit tables, patterns, weights and thresholds below are data of the matching task (Dutch grocery
vocabulary, label texts on product pages, tuned weights), not settings of the engine.
"""

# Unit synonyms -> canonical unit.
UNIT_SYNONYMS = {
    "kilo": "kg",
    "gr": "g",
    "gram": "g",
    "liter": "l",
    "stuks": "stuk",
    "bos": "stuk",
    "pakket": "stuk",
    "cups": "stuk",
    "zakjes": "stuk",
    "plakjes": "stuk",
    "dozen": "stuk",
    "Tros": "stuk",
    "min": "stuk",
    "personen": "stuk",
    "tabletten": "stuk",
}

# Unit -> (base unit, divisor), per kind of catalogue.
BASE_UNITS_TEXT = {"g": ("kg", 1000), "ml": ("l", 1000)}
BASE_UNITS_FIELDS = {"g": ("kg", 1000), "ml": ("l", 1000), "cl": ("l", 100)}

# Factor to the base unit inside a multipack text such as "6 x 330 ml"; other units count 1.
MULTIPACK_FACTORS = {"ml": 1 / 1000, "cl": 1 / 100, "l": 1.0, "liter": 1.0, "g": 1 / 1000, "gram": 1 / 1000, "gr": 1 / 1000, "kg": 1.0}

# Size patterns. (?U) makes \s and \d cover the same Unicode classes as in a Python pattern.
NUMBER = r"\d+(?:[.,]\d+)?"
UNIT_WORDS = r"kg|kilo|g|gr|gram|ml|liter|l|stuk|stuks|st\.?|pak|pakket|bos|cups?|zakjes?"
# A number may begin only where no digit stands before it, and blanks before it only where a run of blanks begins: other
# beginnings can match nothing more, and without them a text of any length is read in linear time.
SIZE_PATTERN = rf"(?U)(?<!\d)({NUMBER})\s*({UNIT_WORDS})"
STRICT_SIZE_PATTERN = rf"(?U)(?<!\d)({NUMBER})\s*({UNIT_WORDS})(?!\w)"
TRAILING_SIZE_PATTERN = rf"(?iU)(?:(?<!\s)\s++|(?<![\s\d]))(?:{NUMBER}\s*(?:{UNIT_WORDS})|\d+\s*+(?:-\s*+)?pack)\s*$"
MULTIPACK_PATTERN = rf"(?U)(?<!\d)(\d+)\s*x\s*({NUMBER})\s*([a-zA-Z]+)"

# Nutrient labels in a backslash-separated nutrient text -> column. The order is that of the output columns.
NUTRIENT_LABELS = {
    "Koolhydraten": "carbs_g",
    "Vet": "fat_g",
    "Eiwitten": "protein_g",
    "Zout": "salt_g",
    "waarvan verzadigd": "saturated_fat_g",
    "waarvan suikers": "sugars_g",
    "Voedingsvezel": "fiber_g",
}

# Part of a nutrient label on a product page -> column; the first that fits a label wins.
PAGE_NUTRIENT_PARTS = {
    "kcal": "kcal",
    "Koolhyd": "carbs_g",
    "Vet": "fat_g",
    "Eiwit": "protein_g",
    "Zout": "salt_g",
}

# Words in an ingredient list that decide the diet flags.
MEAT_WORDS = ("kip", "rund", "varken", "lam", "vlees", "VIS")
DAIRY_WORDS = ("MELK", "BOTER", "YOGHURT", "ROOM", "honing", "wei", "wei-eiwit")
EGG_WORDS = ("EIGEEL", "EIPOEDER")
EGG_EXACT = r"(?U)\bEI\b"
ALLERGEN_MARK = "Allergenen:"

# Own-brand patterns per kind of shop.
OWN_BRAND_PATTERNS = {
    "a": "1 de Beste",
    "b": "AH|Perla|Delicata|De Zaanse Hoeve|Zaanlander|Brouwers",
}

# Words that never name a product. "passiezaanlander" is one word in the list to match.
STOPWORDS = (
    "1", "de", "beste", "vleeschmeesters", "met", "ah", "terra", "perla", "delicata", "zaanse", "hoeve", "liefde",
    "&", "passiezaanlander", "brouwers", "streeckgenoten",
    "en", "op", "bij", "het", "voor", "van", "groot", "grote", "klein", "kleine", "verpakt", "zak", "vers", "verse",
    "los", "extra", "mini",
)

# Vocabulary bounds and number of block tokens.
MIN_DOC_COUNT = 3
MAX_DOC_SHARE = 0.2
MIN_TOKEN_LENGTH = 3
SINGLE_TOKENS = 4
PAIR_TOKENS = 5

# Weights and thresholds of the match score.
WEIGHTS = {"embedding": 0.35, "fuzz": 0.25, "jaccard": 0.10, "quantity": 0.25, "price": 0.05}
PAIR_THRESHOLD = 0.6
MATCH_THRESHOLD = 0.78
OUTLIER_SHARE = 0.4
MACRO_SHARE_LIMIT = 1.1

# Label sample, draws per score tercile (high, middle, low) and seed.
SAMPLE_DRAWS = (150, 300, 150)
SAMPLE_SEED = 42

# Page markup.
EXCLUDED_CATEGORIES = (
    "/boodschappen/huishoud-huisdieren",
    "/boodschappen/kind-drogisterij",
    "/boodschappen/non-food",
)
INGREDIENTS_TITLE = "Ingrediënten"
INGREDIENTS_PREFIX = r"(?U)^Ingrediënten\s*:\s*"
