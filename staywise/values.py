"""Fixed values of the data contract: tokens, patterns, labels, column names, spellings, domains."""

# Spellings of a missing text, compared exactly.
NULL_TOKENS = (
    "",
    " ",
    "  ",
    "   ",
    "nan",
    "NaN",
    "NAN",
    "None",
    "JE ne sais pas",
    "je ne sais pas",
    "Je ne sais pas",
    "Unknow",
    "Unknown",
    "non pertinent",
    "Non pertinent",
    "NON PERTINENT",
)

# Fields that a CSV reader of the pandas kind takes for missing.
CSV_NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The characters that count as white space at the ends of a text.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Patterns of a key, of a coded level and of a number.
KEY_PATTERN = r"(\d+)"
CODE_PATTERN = r"(-?\d+(?:[.,]\d+)?)"
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"

# Spellings of the target and their class.
TARGET_LABELS = {
    "1": 1,
    "0": 0,
    "oui": 1,
    "non": 0,
    "true": 1,
    "false": 0,
    "quitte": 1,
    "reste": 0,
    "yes": 1,
    "no": 0,
}

# Key, target and output columns.
KEY = "id_employee"
TARGET = "a_quitte_l_entreprise"
EVALUATION_KEY = "eval_number"
SURVEY_KEY = "code_sondage"
PROBABILITY = "proba_depart"
DECISION = "prediction"

# Numeric feature columns, the derived ones last but for the change of grade.
NUMERIC_COLUMNS = (
    "age",
    "revenu_mensuel",
    "annees_dans_l_entreprise",
    "annees_dans_le_poste_actuel",
    "annees_depuis_la_derniere_promotion",
    "distance_domicile_travail",
    "nombre_participation_pee",
    "note_evaluation_actuelle",
    "note_evaluation_precedente",
    "annees_depuis_le_changement_deposte",
    "annee_experience_totale",
    "augementation_salaire_precedente",
    "nombre_experiences_precedentes",
    "nb_formations_suivies",
    "nombre_employee_sous_responsabilite",
    "satisfaction_employee_environnement",
    "satisfaction_employee_nature_travail",
    "satisfaction_employee_equipe",
    "satisfaction_employee_equilibre_pro_perso",
    "augmentation_par_revenu",
    "annee_sur_poste_par_experience",
    "nb_formation_par_experience",
    "score_moyen_satisfaction",
    "dern_promo_par_experience",
    "evolution_note",
)

# Categorical feature columns.
CATEGORICAL_COLUMNS = (
    "genre",
    "statut_marital",
    "departement",
    "poste",
    "niveau_hierarchique_poste",
    "niveau_education",
    "domaine_etude",
    "frequence_deplacement",
    "heure_supplementaires",
)

# Satisfaction scores, averaged into one.
SATISFACTION_COLUMNS = (
    "satisfaction_employee_environnement",
    "satisfaction_employee_nature_travail",
    "satisfaction_employee_equipe",
    "satisfaction_employee_equilibre_pro_perso",
)

# Columns shown first in a report.

# Categorical columns that hold a coded level.
CODED_COLUMNS = ("niveau_hierarchique_poste", "niveau_education")

# Percent column, and the derived ratios as output, numerator, denominator.
PERCENT_COLUMNS = ("augementation_salaire_precedente",)
RATIOS = (
    ("augmentation_par_revenu", "augementation_salaire_precedente", "revenu_mensuel"),
    ("annee_sur_poste_par_experience", "annees_dans_le_poste_actuel", "annee_experience_totale"),
    ("nb_formation_par_experience", "nb_formations_suivies", "annee_experience_totale"),
    ("dern_promo_par_experience", "annees_depuis_la_derniere_promotion", "annee_experience_totale"),
)
MEAN_OUTPUT = "score_moyen_satisfaction"
DELTA = ("evolution_note", "note_evaluation_actuelle", "note_evaluation_precedente")

# Canonical spelling of each category, by its lower-case variants.
CATEGORY_SYNONYMS = {
    "genre": {"f": "F", "femme": "F", "m": "M", "homme": "M"},
    "statut_marital": {
        "célibataire": "Célibataire",
        "celibataire": "Célibataire",
        "marié(e)": "Marié(e)",
        "marie(e)": "Marié(e)",
        "marie": "Marié(e)",
        "marié": "Marié(e)",
        "divorcé(e)": "Divorcé(e)",
        "divorce(e)": "Divorcé(e)",
    },
    "departement": {
        "commercial": "Commercial",
        "consulting": "Consulting",
        "ressources humaines": "Ressources Humaines",
    },
    "poste": {
        "cadre commercial": "Cadre Commercial",
        "assistant de direction": "Assistant de Direction",
        "consultant": "Consultant",
        "tech lead": "Tech Lead",
        "manager": "Manager",
        "senior manager": "Senior Manager",
        "représentant commercial": "Représentant Commercial",
        "representant commercial": "Représentant Commercial",
        "directeur technique": "Directeur Technique",
        "ressources humaines": "Ressources Humaines",
    },
    "frequence_deplacement": {
        "aucun": "Aucun",
        "aucune": "Aucun",
        "occasionnel": "Occasionnel",
        "occasionnelle": "Occasionnel",
        "frequent": "Frequent",
        "fréquent": "Frequent",
    },
    "domaine_etude": {
        "entrepreunariat": "Entrepreunariat",
        "infra & cloud": "Infra & Cloud",
        "infra et cloud": "Infra & Cloud",
        "marketing": "Marketing",
        "ressources humaines": "Ressources Humaines",
        "transformation digitale": "Transformation Digitale",
    },
    "heure_supplementaires": {"oui": "Oui", "o": "Oui", "y": "Oui", "non": "Non", "n": "Non"},
    "niveau_hierarchique_poste": {
        "junior": "Junior",
        "confirmé": "Confirmé",
        "confirme": "Confirmé",
        "direction": "Direction",
        "senior": "Senior",
    },
    "niveau_education": {"licence": "Licence", "master": "Master", "doctorat": "Doctorat", "bts": "BTS"},
}

# Allowed categories after normalisation, and the range of the 1 to 5 scores.
CATEGORY_DOMAINS = {
    "genre": ("F", "M"),
    "frequence_deplacement": ("Aucun", "Occasionnel", "Frequent"),
    "statut_marital": ("Célibataire", "Marié(e)", "Divorcé(e)"),
    "departement": ("Commercial", "Consulting", "Ressources Humaines"),
    "poste": (
        "Cadre Commercial",
        "Assistant de Direction",
        "Consultant",
        "Tech Lead",
        "Manager",
        "Senior Manager",
        "Représentant Commercial",
        "Directeur Technique",
        "Ressources Humaines",
    ),
    "domaine_etude": (
        "Entrepreunariat",
        "Infra & Cloud",
        "Marketing",
        "Ressources Humaines",
        "Transformation Digitale",
    ),
    "heure_supplementaires": ("Oui", "Non"),
}
SCORE_RANGE = (1.0, 5.0)
SCORE_COLUMNS = ("note_evaluation_actuelle", "note_evaluation_precedente", *SATISFACTION_COLUMNS)

DECISION_TEXT = {1: "Risque de départ", 0: "Reste probable"}

# Search grids of the two model families.
LOGISTIC_GRID = {"C": (0.1, 1.0, 10.0), "penalty": ("l1", "l2")}
FOREST_GRID = {"trees": (200, 300, 500), "depth": (6, 8, 10), "split": (5, 10, 15), "leaf": (2, 5, 8)}
LOGISTIC_MAX_ITER = 2000
FOLDS = 5
SMOTE_NEIGHBOURS = 5
RANDOM_STATE = 42
F1_EPSILON = 1e-8
DEFAULT_THRESHOLD = 0.5
EXPLAIN_SAMPLE = 500
TOP_FEATURES = 10
