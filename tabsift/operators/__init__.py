"""Operators: plain functions over DataFrames (usable with ``df.transform``) and ML fits.

profile   P1-P11  single-pass profiles (nulls, sentinels, NaN/Inf, uncastable, constants, classes)
clean     C1-C18  names, sentinels, casts, imputation, fills, constants, de-duplication, clamps
encode    F1-F4   category index, one-hot, vector assembly, slot names
weights   A4      balanced class weights
split     M2      key-hash train/test split
features  F5-F11  scaling, PCA, explained variance, importances, selection, back-projection
model     M1-M4   forest, per-config pipelines, scoring, save/load
evaluate  M5-M10  weighted precision / recall / F1 / accuracy, configuration comparison
"""
