"""Graph construction, keyed, ordered, counting and merge operators."""
