"""Texts no operator may stumble over."""

ODD = [(None, "a null id"), (900, None), (901, ""), (902, " \n\t "), (903, "!?."), (904, "é" * 40), (904, "é" * 40), (905, "x" * 5000)]
