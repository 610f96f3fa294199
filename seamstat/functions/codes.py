"""Fixed values that must equal the source definitions for right results.

FIXED VALUES: event-code sets, pitch-description sets, lookup tables,
regression constants and column lists, stated plainly in natural order.
"""

# --- FIXED VALUES: plate-appearance event codes --------------------------
NOT_A_PA = ("truncated_pa", "ejection", "game_advisory")
HIT = ("single", "double", "triple", "home_run")
NOT_AN_AT_BAT = ("walk", "intent_walk", "hit_by_pitch", "sac_fly",
                 "sac_fly_double_play", "sac_bunt", "sac_bunt_double_play",
                 "catcher_interf")
SINGLE = ("single",)
DOUBLE = ("double",)
TRIPLE = ("triple",)
HOME_RUN = ("home_run",)
WALK = ("walk", "intent_walk")
INTENT_WALK = ("intent_walk",)
HIT_BY_PITCH = ("hit_by_pitch",)
STRIKEOUT = ("strikeout", "strikeout_double_play")
SAC_FLY = ("sac_fly", "sac_fly_double_play")
SAC_BUNT = ("sac_bunt", "sac_bunt_double_play")
CATCHER_INTERF = ("catcher_interf",)
GIDP = ("grounded_into_double_play", "double_play", "strikeout_double_play",
        "sac_fly_double_play", "sac_bunt_double_play", "triple_play")
ONE_OUT = ("field_out", "strikeout", "force_out", "sac_fly", "sac_bunt",
           "fielders_choice", "fielders_choice_out")
TWO_OUTS = ("grounded_into_double_play", "double_play", "strikeout_double_play",
            "sac_fly_double_play", "sac_bunt_double_play")
THREE_OUTS = ("triple_play",)
FLY_BALL = "fly_ball"

# --- FIXED VALUES: pitch descriptions ------------------------------------
WHIFF = ("swinging_strike", "swinging_strike_blocked")
SWING = ("swinging_strike", "swinging_strike_blocked", "foul", "foul_tip",
         "foul_bunt", "hit_into_play", "hit_into_play_no_out",
         "hit_into_play_score")

# --- FIXED VALUES: lookups -----------------------------------------------
LEVEL_RANK = {"AAA": 1, "AA": 2, "High-A": 3, "Single-A": 4}
SPORT_LEVEL = {11: "AAA", 12: "AA", 13: "High-A", 14: "Single-A"}
POSITION_GROUP = {"C": "catcher", "SS": "speed_pos", "CF": "speed_pos",
                  "2B": "speed_pos", "RF": "corner", "LF": "corner",
                  "3B": "corner", "1B": "power", "DH": "power",
                  "OF": "speed_pos"}
POSITION_GROUP_DEFAULT = "other"
MILB_FIP_CONSTANT_DEFAULT = 3.10

# --- FIXED VALUES: regression-to-the-mean sample sizes ---------------------
HITTER_RELIABILITY = {"avg": 500, "obp": 400, "slg": 300, "ops": 350,
                      "woba": 350, "iso": 200, "bb_rate": 120, "k_rate": 60}
PITCHER_RELIABILITY = {"era": 80, "whip": 70, "k_pct": 40, "bb_pct": 50,
                       "babip": 120, "hr_9": 100, "fip": 60,
                       "xwoba_against": 60, "hr_fb": 100, "ba_against": 80}

# --- FIXED VALUES: column lists ---------------------------------------------
HITTER_ADVANCED = ["avg_exit_velo", "avg_launch_angle", "xba", "xwoba",
                   "barrel_rate", "hard_hit_rate", "swing_rate", "whiff_rate",
                   "chase_rate", "zone_swing_rate", "zone_contact_rate"]
HITTER_ROLLING = HITTER_ADVANCED + ["bb_rate", "k_rate", "iso", "speed_proxy",
                                    "hr_per_batted_ball"]
PITCHER_ADVANCED = ["fb_velo", "ff_velo", "brk_velo", "offspeed_velo",
                    "extension", "whiff_rate", "chase_rate", "zone_rate",
                    "csw_rate", "avg_ev_against", "avg_la_against",
                    "xwoba_against", "barrel_rate_against",
                    "hard_hit_rate_against", "gb_rate", "fb_rate"]
PITCHER_ROLLING = PITCHER_ADVANCED + ["k_pct", "bb_pct", "hr_fb", "babip",
                                      "fb_brk_velo_diff",
                                      "fb_offspeed_velo_diff", "gb_fb_ratio"]
HITTER_TARGETS = ["pa", "avg", "ops", "r", "hr", "rbi", "sb", "tb"]
HITTER_TARGET_DIGITS = {"pa": 0, "avg": 3, "ops": 3, "r": 0, "hr": 0,
                        "rbi": 0, "sb": 0, "tb": 0}
PITCHER_TARGETS = ["ip", "wins", "k", "bb", "era", "whip", "quality_starts",
                   "sv_hld"]
PITCHER_TARGET_DIGITS = {"ip": 1, "wins": 0, "k": 0, "bb": 0, "era": 2,
                         "whip": 2, "quality_starts": 0, "sv_hld": 0}
HITTER_MILB_FILL = ["milb_pa", "milb_avg", "milb_obp", "milb_slg", "milb_ops",
                    "milb_iso", "milb_bb_rate", "milb_k_rate", "milb_hr_rate",
                    "milb_sb_rate"]
PITCHER_MILB_FILL = ["milb_ip", "milb_era", "milb_whip", "milb_k_9",
                     "milb_bb_9", "milb_hr_9", "milb_fip", "milb_k_bb"]
HITTER_ID_COLUMNS = ["player_id", "season", "team", "bat_side",
                     "primary_position", "birth_date", "mlb_debut_date",
                     "pos_group"]
TEAM_STRENGTH_COLUMNS = ["team_runs", "team_ops", "team_hr"]

# --- FIXED VALUES: thresholds and model settings ---------------------------
MIN_PA = 50
MIN_IP = 10
MILB_MIN_PA = 50
MILB_MIN_IP = 10
HITTER_AGE_PEAK, HITTER_POST_PEAK = 27, 28
PITCHER_AGE_PEAK, PITCHER_POST_PEAK = 28, 29
IMPORTANCE_THRESHOLD = 0.005
PARAM_GRID = {"n_estimators": [200, 400], "max_depth": [3, 4, 5],
              "learning_rate": [0.03, 0.05, 0.1],
              "min_child_weight": [3, 5, 10]}
SEED = 42


# --- FIXED VALUES: barrels, (least speed, least angle, greatest angle) ------
BARREL_TIERS = [
    (98, 26, 30), (99, 25, 31), (100, 24, 33), (101, 23, 34), (102, 22, 35),
    (103, 21, 36), (104, 20, 37), (105, 19, 38), (106, 18, 39), (107, 17, 40),
    (108, 16, 41), (109, 15, 42), (110, 14, 43)]


# --- FIXED VALUES: pitch-type groups and batted-ball thresholds -------------
FASTBALL_TYPES = ("FF", "SI", "FC")
FOUR_SEAM_TYPES = ("FF",)
BREAKING_TYPES = ("SL", "CU", "KC", "SV", "ST")
OFFSPEED_TYPES = ("CH", "FS", "FO", "SC")
CALLED_STRIKE = ("called_strike",)
HARD_HIT_SPEED = 95.0
IN_ZONE_MAX = 9
GROUND_BALL = "ground_ball"


# --- FIXED VALUES: columns refreshed when a stored minor-league line is
# loaded again (the others keep their stored value) -------------------------
MILB_BATTING_REFRESHED = ["games", "pa", "ab", "hits", "hr", "avg", "obp", "slg", "ops",
                          "sb", "bb", "so", "tb"]
MILB_PITCHING_KEPT = ["age"]


# --- FIXED VALUES: official season lines, (stored column, payload field) ----
OFFICIAL_BATTING = [
    ("age", "age"), ("games_played", "gamesPlayed"), ("plate_appearances", "plateAppearances"),
    ("at_bats", "atBats"), ("runs", "runs"), ("hits", "hits"), ("doubles", "doubles"),
    ("triples", "triples"), ("home_runs", "homeRuns"), ("rbi", "rbi"),
    ("strike_outs", "strikeOuts"), ("base_on_balls", "baseOnBalls"),
    ("intentional_walks", "intentionalWalks"), ("hit_by_pitch", "hitByPitch"),
    ("stolen_bases", "stolenBases"), ("caught_stealing", "caughtStealing"),
    ("ground_into_dp", "groundIntoDoublePlay"), ("sac_bunts", "sacBunts"),
    ("sac_flies", "sacFlies"), ("total_bases", "totalBases"), ("left_on_base", "leftOnBase"),
    ("ground_outs", "groundOuts"), ("air_outs", "airOuts"),
    ("number_of_pitches", "numberOfPitches"), ("catchers_interference", "catchersInterference"),
    ("avg", "avg"), ("obp", "obp"), ("slg", "slg"), ("ops", "ops"), ("babip", "babip"),
    ("stolen_base_pct", "stolenBasePercentage"), ("caught_stealing_pct", "caughtStealingPercentage"),
    ("go_ao_ratio", "groundOutsToAirouts"), ("ab_per_hr", "atBatsPerHomeRun")]
OFFICIAL_PITCHING = [
    ("age", "age"), ("games_played", "gamesPlayed"), ("games_started", "gamesStarted"),
    ("games_finished", "gamesFinished"), ("complete_games", "completeGames"),
    ("shutouts", "shutouts"), ("wins", "wins"), ("losses", "losses"), ("saves", "saves"),
    ("save_opps", "saveOpportunities"), ("holds", "holds"), ("blown_saves", "blownSaves"),
    ("innings_pitched", "inningsPitched"), ("outs", "outs"), ("hits", "hits"), ("runs", "runs"),
    ("earned_runs", "earnedRuns"), ("home_runs", "homeRuns"), ("strike_outs", "strikeOuts"),
    ("base_on_balls", "baseOnBalls"), ("intentional_walks", "intentionalWalks"),
    ("hit_by_pitch", "hitByPitch"), ("balks", "balks"), ("wild_pitches", "wildPitches"),
    ("pickoffs", "pickoffs"), ("ground_outs", "groundOuts"), ("air_outs", "airOuts"),
    ("doubles", "doubles"), ("triples", "triples"), ("at_bats", "atBats"),
    ("total_bases", "totalBases"), ("batters_faced", "battersFaced"),
    ("number_of_pitches", "numberOfPitches"), ("strikes", "strikes"),
    ("stolen_bases", "stolenBases"), ("caught_stealing", "caughtStealing"),
    ("ground_into_dp", "groundIntoDoublePlay"), ("sac_bunts", "sacBunts"),
    ("sac_flies", "sacFlies"), ("catchers_interference", "catchersInterference"),
    ("inherited_runners", "inheritedRunners"),
    ("inherited_runners_scored", "inheritedRunnersScored"), ("era", "era"), ("whip", "whip"),
    ("avg", "avg"), ("obp", "obp"), ("slg", "slg"), ("ops", "ops"),
    ("strike_percentage", "strikePercentage"), ("win_percentage", "winPercentage"),
    ("stolen_base_pct", "stolenBasePercentage"), ("caught_stealing_pct", "caughtStealingPercentage"),
    ("go_ao_ratio", "groundOutsToAirouts"), ("k_walk_ratio", "strikeoutWalkRatio"),
    ("k_per_9", "strikeoutsPer9Inn"), ("bb_per_9", "walksPer9Inn"), ("h_per_9", "hitsPer9Inn"),
    ("r_per_9", "runsScoredPer9"), ("hr_per_9", "homeRunsPer9"),
    ("pitches_per_inning", "pitchesPerInning")]
# Payload fields that come as text (rates with sentinels such as ".---").
OFFICIAL_TEXT = ["avg", "obp", "slg", "ops", "babip", "era", "whip", "inningsPitched",
                 "stolenBasePercentage", "caughtStealingPercentage", "groundOutsToAirouts",
                 "atBatsPerHomeRun", "strikePercentage", "winPercentage", "strikeoutWalkRatio",
                 "strikeoutsPer9Inn", "walksPer9Inn", "hitsPer9Inn", "runsScoredPer9",
                 "homeRunsPer9", "pitchesPerInning"]
