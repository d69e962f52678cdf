"""The concrete entities, dimensions and facts, and the full run."""
