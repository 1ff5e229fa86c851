"""The gate's steps: rules, tally, split, casts and projection, audit."""
