"""DataFrame operators: windows, novelty, rules, decisions, profiles and replay."""
