"""Pure ``DataFrame -> DataFrame`` operators of the policy pipeline."""
