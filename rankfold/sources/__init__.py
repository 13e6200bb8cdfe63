"""Reading tables, keeping working tables on shared storage, saving models."""
