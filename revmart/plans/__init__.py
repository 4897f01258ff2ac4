"""Relation definitions: staging, dimensions, marts and the presentation
relations of the six dashboard pages, plus the warehouse that wires them."""
