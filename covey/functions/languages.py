"""Languages' codes and names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import looked_up

# The checklist's languages, by their column headers.
CODE_OF_NAME = {
    "Afrikaans": "af", "Arabic": "ar", "Belarusian": "be", "Bulgarian": "bg", "Catalan": "ca", "Czech": "cs", "Danish": "da", "German": "de",
    "Greek": "el", "Spanish": "es", "Estonian": "et", "Persian": "fa", "Finnish": "fi", "French": "fr", "French (Gaudin)": "fr-Gaudin",
    "Hebrew": "he", "Croatian": "hr", "Hungarian": "hu", "Indonesian": "id", "Icelandic": "is", "Italian": "it", "Japanese": "ja",
    "Korean": "ko", "Lithuanian": "lt", "Latvian": "lv", "Macedonian": "mk", "Malayalam": "ml", "Dutch": "nl", "Norwegian": "no",
    "Polish": "pl", "Portuguese (Lusophone)": "pt", "Portuguese (Portuguese)": "pt-PT", "Romanian": "ro", "Russian": "ru",
    "Northern Sami": "se", "Slovak": "sk", "Slovenian": "sl", "Serbian": "sr", "Swedish": "sv", "Thai": "th", "Turkish": "tr",
    "Ukrainian": "uk", "Chinese": "zh", "Chinese (Traditional)": "zh-TW",
}
# The languages that labels are asked for in, and their names.
LABEL_LANGUAGES = {
    "en": "English", "es": "Spanish", "fr": "French", "de": "German", "it": "Italian", "pt": "Portuguese", "nl": "Dutch", "sv": "Swedish",
    "nb": "Norwegian Bokmål", "nn": "Norwegian Nynorsk", "da": "Danish", "fi": "Finnish", "pl": "Polish", "cs": "Czech", "sk": "Slovak",
    "ru": "Russian", "uk": "Ukrainian", "hr": "Croatian", "sr": "Serbian", "lt": "Lithuanian", "zh": "Chinese",
    "zh-hans": "Chinese (Simplified)", "zh-hant": "Chinese (Traditional)", "yue": "Cantonese", "ja": "Japanese", "ko": "Korean",
    "ar": "Arabic", "he": "Hebrew", "tr": "Turkish", "ca": "Catalan", "eu": "Basque", "gl": "Galician", "ro": "Romanian",
    "hu": "Hungarian", "bg": "Bulgarian", "el": "Greek", "th": "Thai", "vi": "Vietnamese", "id": "Indonesian", "ms": "Malay",
    "tl": "Tagalog", "hi": "Hindi", "bn": "Bengali", "ta": "Tamil", "te": "Telugu", "ml": "Malayalam", "kn": "Kannada", "mr": "Marathi",
    "gu": "Gujarati", "pa": "Punjabi", "ur": "Urdu", "fa": "Persian", "et": "Estonian", "lv": "Latvian", "sl": "Slovenian",
    "is": "Icelandic", "af": "Afrikaans",
}
#: Names of the checklist's codes; plain Portuguese is shown without its qualifier.
CHECKLIST_NAMES = {code: "Portuguese" if code == "pt" else name for name, code in CODE_OF_NAME.items()}


def code_of(name: Column) -> Column:
    """A header's code, null for what is no language."""
    return looked_up(CODE_OF_NAME, name, F.lit(None).cast("string"))


def name_of(code: Column, names: dict[str, str] = LABEL_LANGUAGES) -> Column:
    """A code's name, the code in upper case where it has none."""
    return looked_up(names, code, F.upper(code))


def wanted(code: Column) -> Column:
    return code.isin(*LABEL_LANGUAGES)
