"""Fixed values. Results depend on these exact words, marks and numbers."""

# Arabic stop words, in the spelling they are compared with (after normalisation).
STOPWORDS = tuple(
    """
    في من إلى على عن مع هذا هذه ذلك التي الذي
    وقد كما إلا أن إن كان لا ما هو هي لم لن
    قد أو حتى أي بين له لها بما عند كل بعد قبل
    ثم منذ خلال حول نحو غير بل لكن وهو وهي فإن
    وأن أما إذا كانت وكان أيضا فقد وفي ومن وعلى
    وإن كذلك ولا ولم وكانت أنه أنها إنه إنها
    """.split()
)

# Light stemming: affixes in the order they are tried, and what must remain.
STEM_PREFIXES = "ال وال بال كال فال لل و ف ب ك ل س".split()
STEM_SUFFIXES = "ها هم هن كم كن نا ون ين ان ات وا ية".split()
STEM_MIN_LENGTH = 3

# Prepositions counted as genitive markers.
PREPOSITIONS = "في من إلى على عن مع".split()

# Punctuation marks counted by the diversity feature.
PUNCTUATION = tuple("،؛؟!:.,\"'()[]{}")

# Stylometric features in vector order, with the names used in reports.
FEATURES = {
    "f3_digits_ratio": "f3  - digits/C",
    "f24_punct_div": "f24 - punct/C",
    "f45_adj_count": "f45 - adjectives",
    "f66_genitive_count": "f66 - genitives",
    "f87_gini": "f87 - Gini coeff",
}

# Published coefficients of the logistic model for those features.
COEFFICIENTS = {
    "f24_punct_div": -58.637206,
    "f3_digits_ratio": 5.037039,
    "f87_gini": 1.110944,
    "f66_genitive_count": 0.024537,
    "f45_adj_count": -0.003263,
}

# Vector and model parameters.
TFIDF_DIMENSIONS = 5000
MIN_DOC_FREQ = 3
LOGISTIC_PARAMS = {"maxIter": 20, "regParam": 0.01}
FOREST_PARAMS = {"numTrees": 50, "maxDepth": 10, "seed": 42}
SVM_PARAMS = {"maxIter": 20, "regParam": 0.005}
WORD2VEC_DIMENSIONS = 50

# Report names of the models.
MODEL_NAMES = {
    "lr": "Logistic Regression (Baseline)",
    "rf": "Random Forest",
    "svm": "Linear SVM",
}

# Rows in one reported stream batch, and sample sizes of the reports.
ERROR_SAMPLE_ROWS = 5
ERROR_TEXT_CHARS = 300
PREVIEW_ROWS = 3
PREVIEW_CHARS = 80
