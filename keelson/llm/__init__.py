"""Training-data operators (see the README section "Training-data operators")."""
