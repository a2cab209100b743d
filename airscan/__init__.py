"""Wireless-survey analytics on Spark DataFrames."""

from airscan.operators.phrases import phrase_list
from airscan.operators.signals import Thresholds
from airscan.plans.compare_scans import compare_paths, compare_scans
from airscan.plans.detector import scan_logs
from airscan.plans.survey import SurveyJob
from airscan.sources.survey_csv import read_logs

__all__ = ["SurveyJob", "Thresholds", "compare_paths", "compare_scans", "phrase_list", "read_logs", "scan_logs"]
