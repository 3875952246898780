"""Rare toxic texts weigh as much as clean ones in the classifier of operator 13."""

import numpy as np

from starloom.llm import toxicity


def test_a_rare_class_weighs_as_much():
    toxic = np.arange(1000) < 20
    term = toxic | (np.arange(1000) >= 988)             # every toxic text has it, and 12 of 980 clean ones
    target, plain = np.where(toxic, 0.98, 0.02), np.ones(1000)
    even = toxicity.even_weights(target, plain)
    assert np.isclose(even[toxic].sum(), even[~toxic].sum())

    def score(weight):
        beta, intercept = toxicity.fit_logistic(term[:, None], toxic.astype(float), weight)
        return 1 / (1 + np.exp(-(intercept + beta[0]))), 1 / (1 + np.exp(-intercept))
    assert score(plain)[0] < 0.7                        # as it was
    assert score(even)[0] > 0.9 and score(even)[1] < 0.1


def test_a_class_of_no_weight_is_harmless():
    assert np.isfinite(toxicity.even_weights(np.zeros(3), np.ones(3))).all()
