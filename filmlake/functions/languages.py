"""Labels of the language codes."""

from __future__ import annotations

# Code and printed label. Two codes share the label "Chinês".
LANGUAGE_LABELS = {
    "ho": "Hiri Motu",
    "cn": "Chinês",
    "tn": "Tswana",
    "te": "Telugu",
    "cy": "Galês",
    "tl": "Tagalo",
    "ja": "Japonês",
    "sd": "Sindi",
    "hi": "Hindi",
    "ml": "Malaiala",
    "mi": "Maori",
    "ta": "Tâmil",
    "en": "Inglês",
    "no": "Norueguês",
    "zh": "Chinês",
    "mr": "Marata",
    "ko": "Coreano",
    "ms": "Malaio",
    "it": "Italiano",
    "ga": "Irlandês",
    "th": "Tailandês",
    "bn": "Bengali",
    "kn": "Canarês",
    "pa": "Panjabi",
    "ur": "Urdu",
    "ru": "Russo",
    "cs": "Checo",
    "es": "Espanhol",
    "is": "Islandês",
    "fr": "Francês",
    "id": "Indonésio",
    "fi": "Finlandês",
    "sv": "Sueco",
    "bo": "Tibetano",
    "nl": "Holandês",
    "de": "Alemão",
    "el": "Grego",
    "sk": "Eslovaco",
    "ht": "Haitiano",
    "la": "Latim",
    "ar": "Árabe",
    "bs": "Bósnio",
    "hu": "Húngaro",
    "da": "Dinamarquês",
    "he": "Hebraico",
    "tr": "Turco",
    "sl": "Esloveno",
    "bg": "Búlgaro",
    "af": "Afrikaans",
    "et": "Estoniano",
    "si": "Cingalês",
    "sr": "Sérvio",
    "pl": "Polaco",
    "sh": "Servo-Croata",
    "eu": "Basco",
    "lv": "Letão",
    "fa": "Persa",
    "ne": "Nepalês",
    "mn": "Mongol",
    "ca": "Catalão",
    "ro": "Romeno",
    "lt": "Lituano",
    "hy": "Armênio",
    "pt": "Português",
    "gu": "Gujarati",
    "sq": "Albanês",
    "ig": "Igbo",
    "hr": "Croata",
    "vi": "Vietnamita",
    "ku": "Curdo",
    "tg": "Tadjique",
    "sn": "Shona",
    "yi": "Iídiche",
    "yo": "Yoruba",
    "lb": "Luxemburguês",
    "az": "Azerbaijano",
    "mk": "Macedônio",
    "tt": "Tártaro",
    "xx": "Indeterminado",
    "ka": "Georgiano",
    "mt": "Maltês",
    "am": "Amárico",
    "uk": "Ucraniano",
    "mg": "Malgaxe",
    "kk": "Cazaque",
    "cr": "Cree",
    "ps": "Pastó",
    "ak": "Acan",
    "zu": "Zulu",
    "dz": "Dzongkha",
    "nb": "Bokmål Norueguês",
    "my": "Birmanês",
    "gl": "Galego",
    "sw": "Suaíli",
    "sc": "Sardo",
    "be": "Bielorrusso",
    "km": "Khmer",
    "ab": "Abcásio",
    "ia": "Interlíngua",
    "qu": "Quéchua",
    "kw": "Córnico",
    "uz": "Uzbeque",
    "fo": "Feroês",
    "ha": "Hauçá",
    "as": "Assamês",
    "ky": "Quirguiz",
    "fj": "Fijiano",
    "wo": "Wolof",
    "or": "Oriya",
    "jv": "Javanês",
    "to": "Tonganês",
    "gd": "Gaélico Escocês",
    "gn": "Guarani",
    "bm": "Bambara",
    "br": "Bretão",
    "se": "Sami do Norte",
    "iu": "Inuktitut",
    "ss": "Swati",
    "lo": "Lao",
    "fy": "Frísio Ocidental",
    "nn": "Norueguês Nynorsk",
    "ng": "Ndonga",
    "tk": "Turcomano",
    "ts": "Tsonga",
}
