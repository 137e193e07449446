"""Operators: running moments, breaches, sensor states, alarm, summaries, lines, words, baselines."""
