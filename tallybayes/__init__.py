"""tallybayes: Naive Bayes analytics as plain Spark DataFrame plans.

Text (multinomial) and tabular (categorical) Naive Bayes, trained by
distributed counting and scored by joining rows to a model kept as tables.
Every step is a DataFrame operator: no Python UDF and no counts on the driver.
"""

from tallybayes.operators.model import (
    CategoricalModel,
    MultinomialModel,
    NaiveBayes,
    fit_categorical,
    fit_multinomial,
)
from tallybayes.session import get_session, scratch_dir

__all__ = [
    "CategoricalModel",
    "MultinomialModel",
    "NaiveBayes",
    "fit_categorical",
    "fit_multinomial",
    "get_session",
    "scratch_dir",
]
