"""Silver entities, gold marts, reports and the job that writes the layers."""
