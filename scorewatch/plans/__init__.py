"""Whole runs put together from operators: train, evaluate, calibrate, drift, noise, business."""
