"""Planning of features and whole training or prediction flows."""
