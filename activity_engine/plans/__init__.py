"""The concrete models: staging, dimensions, facts, marts, feeds, checks and the full run."""
