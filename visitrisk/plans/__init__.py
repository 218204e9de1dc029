"""The three jobs: train, score, load."""
