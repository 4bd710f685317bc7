"""Word lists, character tables and templates used by the operators."""

# Look-alike punctuation and its plain counterpart, one sign for one sign.
PUNCTUATION_ONE_TO_ONE = {
    "【": "[",
    "】": "]",
    "━": "-",
    "，": ",",
    "。": ".",
    "、": ",",
    "；": ";",
    "：": ":",
    "？": "?",
    "！": "!",
    "（": "(",
    "）": ")",
    "《": '"',
    "》": '"',
    "「": '"',
    "」": '"',
    "“": '"',
    "”": '"',
    "„": '"',
    "‘": "'",
    "’": "'",
    "´": "'",
    "∶": ":",
    "％": "%",
    "–": "-",
    "—": "-",
    "～": "~",
}

# Signs that become several plain ones.
PUNCTUATION_SPELLED_OUT = {"…": "..."}

# Frequent function words per language.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "is", "in", "for", "it", "was", "on", "are", "as", "by", "this", "at", "from"],
    "nl": ["de", "het", "een", "en", "van", "in", "is", "dat", "op", "te", "met", "voor", "die", "niet", "zijn", "aan", "er", "om", "ook", "als"],
    "de": ["der", "die", "das", "und", "in", "zu", "den", "von", "mit", "ist", "im", "für", "auf", "nicht", "ein", "eine", "dem", "des", "sich", "auch"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "du", "en", "que", "qui", "dans", "pour", "pas", "sur", "au", "avec", "ce", "il"],
    "es": ["el", "la", "los", "las", "de", "y", "en", "un", "una", "que", "se", "por", "con", "para", "del", "al", "es", "no", "su", "lo"],
    "da": ["og", "i", "at", "det", "en", "den", "til", "er", "som", "på", "de", "med", "han", "af", "for", "ikke", "der", "et", "har", "om"],
    "sv": ["och", "i", "att", "det", "en", "som", "på", "är", "av", "för", "med", "den", "till", "inte", "har", "de", "ett", "om", "var", "men"],
    "af": ["die", "van", "en", "in", "is", "het", "wat", "vir", "te", "nie", "met", "op", "dat", "om", "was", "sy", "hy", "aan", "as", "ook"],
    "fy": ["de", "it", "fan", "en", "in", "is", "dat", "op", "te", "mei", "foar", "net", "oan", "hy", "wie", "ek", "as", "om", "syn", "ta"],
}

# First failing rule wins in this order of entity types when spans are equally long.
PII_PRECEDENCE = [
    "EMAIL_ADDRESS",
    "URL",
    "IP_ADDRESS",
    "BANK_ACCOUNT",
    "CREDIT_CARD",
    "SSN",
    "PHONE_NUMBER",
    "CREDIT_CARD_EXPIRATION",
    "CVV",
    "PASSPORT_NUMBER",
    "DRIVER_LICENSE",
    "HEALTHCARE_NUMBER",
    "LOCATION_COORDINATE",
    "LOCATION_ZIP",
    "VEHICLE_ID",
    "NUMERICAL_PII",
    "NAME",
    "NAME_MEDICAL_PROFESSIONAL",
    "NAME_GIVEN",
    "NAME_FAMILY",
    "LOCATION_ADDRESS",
    "LOCATION_ADDRESS_STREET",
    "USERNAME",
]

# Replacement material per locale.
LOCALE_TERMS = {
    "nl-NL": {
        "given": ["Anna", "Bram", "Daan", "Emma", "Femke", "Jan", "Lotte", "Sven"],
        "family": ["Bakker", "de Boer", "de Vries", "Jansen", "Mulder", "Smit", "Visser", "van Dijk"],
        "street": ["Dorpsstraat", "Kerkstraat", "Molenweg", "Schoolstraat", "Stationsweg", "Julianalaan"],
        "town": ["Almelo", "Breda", "Delft", "Gouda", "Leiden", "Zwolle"],
        "word": ["appel", "boom", "dijk", "fiets", "haven", "kaas", "molen", "tulp"],
    },
    "en-GB": {
        "given": ["Alice", "Ben", "Chloe", "David", "Emily", "George", "Harry", "Lucy"],
        "family": ["Brown", "Clarke", "Davies", "Evans", "Jones", "Smith", "Taylor", "Wilson"],
        "street": ["Church Road", "High Street", "London Road", "Mill Lane", "Park Road", "Station Road"],
        "town": ["Bath", "Derby", "Exeter", "Leeds", "Oxford", "York"],
        "word": ["apple", "bridge", "cloud", "field", "harbour", "maple", "river", "stone"],
    },
}

# Default instruction of the rewriting stage.
PARAGRAPH_PROMPT = (
    "Given the following sentences, produce a fluent and coherent paragraph that contains all the "
    "information in the sentences. Do not generate any information that is not in the sentences. Ensure "
    "that the paragraph is grammatically and syntactically correct in Dutch. Do not produce any additional "
    "text, only the paragraph.\nSentences:\n{text}\n\nParagraph:\n"
)
